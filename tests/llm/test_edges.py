"""Every operator and stage on rows with NULLs, empty and long texts, ties, repeated rows and clashing columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from beatlake.llm import decontaminate, html, langid, mixing, quality, rules, simhash, substrings, toxicity, warc

LONG = " ".join(f"word{n % 997} und{n % 13}" for n in range(40_000))
GOOD = " ".join(f"plain{n}" for n in range(80))
DOCUMENTS = [
    (1, GOOD, "en", "a", 1, 5), (2, GOOD, "en", "a", 2, 5), (2, GOOD, "en", "a", 2, 5), (None, GOOD, None, None, None, None),
    (3, "", "de", None, 0, 0), (4, None, "de", "b", None, 1), (5, LONG, "de", "b", 3, 1), (6, "éß \x00 中", "xx", "", 1, 1),
    (-7, "1 2 3 !!!", "en", "a", 1, 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long"
PAGE = "<html><body><nav><a>menu</a></nav><article><h1>T</h1><p>one &amp; two</p></article><footer>All rights reserved</footer></body></html>"
PAGES = [
    (1, "http://h.example/a", PAGE, 1), (2, "http://h.example/b", PAGE, 1), (2, "http://h.example/b", PAGE, 1),
    (None, None, PAGE, 1), (3, "no address", "", 2), (4, "http://h.example/c", None, 2), (5, "http://h.example/d", "<p>" + LONG, 3),
]


@pytest.fixture(scope="module")
def tables(spark):
    # Columns clash with names that the operators give to their own results.
    documents = spark.createDataFrame(DOCUMENTS, SCHEMA).withColumn("row", F.lit("x")).withColumn("score", F.lit(9))
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (2, 1, 1), (5, 0, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    benchmark = spark.createDataFrame([(1, " ".join(GOOD.split()[3:20])), (2, None), (None, ""), (3, "word1 und1"), (3, "word1 und1")], "item_id long, text string")
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string, text int")
    return documents, labels, benchmark, pages


def results(documents, labels, benchmark, pages):
    return {
        "mix": mixing.mix(documents), "toxicity": toxicity.judged(documents, labels), "quality": quality.judged(documents, labels),
        "simhash": simhash.near_duplicates(documents), "decontaminate": decontaminate.judge(documents, benchmark),
        "html": html.extract(pages), "substrings": substrings.without_repeats(documents), "language": langid.judged(documents),
        "rules": rules.rate(documents, labels), "warc": warc.archived(pages),
    }


def test_odd_rows(tables):
    found = {name: frame.collect() for name, frame in results(*tables).items()}
    for name, rows in found.items():
        assert len(rows) == (len(PAGES) if name in ("html", "warc") else len(DOCUMENTS)), name
    by = {name: {row[0]: row for row in rows} for name, rows in found.items()}
    assert by["mix"][4].taken == by["mix"][3].taken == 0
    assert all(row.taken <= 2 * row.size for row in found["mix"])
    assert by["toxicity"][3].score == by["toxicity"][4].score and all(0 <= row.score <= 1 for row in found["toxicity"])
    assert by["quality"][3].score == by["quality"][4].score and all(0 <= row.score <= 1 for row in found["quality"])
    assert by["simhash"][3].fingerprint == "0" * 16 and by["simhash"][4].component_id == 3
    assert by["simhash"][None].component_id == 1 == by["simhash"][2].component_id
    assert by["decontaminate"][1].n_hit == 17 and by["decontaminate"][1].contaminated and not by["decontaminate"][4].contaminated
    assert by["decontaminate"][5].n_items == 1
    assert by["html"][1].text == "T\none & two" and by["html"][4].text == "" and by["html"][5].text == LONG
    # NULL ids come first, so all other copies of the text go.
    gone = {row.doc_id: (row.n_bytes, row.n_removed) for row in found["substrings"]}
    assert gone[None] == (len(GOOD), 0) and gone[1] == gone[2] == (len(GOOD), len(GOOD)) and gone[4] == (0, 0)
    assert by["language"][4].lang_pred == "und" == by["language"][-7].lang_pred and by["language"][5].lang_pred in ("de", "en", "xx")
    assert by["rules"][4].base_failed and by["rules"][1].n_words == 80
    kinds = sorted((row.page_id, row.record_type, row.refers_to) for row in found["warc"] if row.page_id in (1, 2))
    assert kinds == [(1, "response", None), (2, "revisit", 1), (2, "revisit", 1)] and by["warc"][None].refers_to == 1


def test_empty_tables(tables):
    for name, frame in results(*(frame.limit(0) for frame in tables)).items():
        assert frame.count() == 0, name


def test_without_labels_and_items(tables):
    documents, labels, benchmark, _ = tables
    nothing = labels.limit(0)
    assert {row.score for row in toxicity.judged(documents, nothing).collect()} == {0.5}
    assert {row.score for row in quality.judged(documents, nothing).collect()} == {0.5}
    assert all(row.kept != row.base_failed for row in rules.rate(documents, nothing).collect())
    assert not any(row.n_hit for row in decontaminate.judge(documents, benchmark.limit(0)).collect())
    unknown = documents.withColumn("lang", F.lit(None).cast("string"))
    assert {(row.lang_pred, row.score) for row in langid.judged(unknown).collect()} == {("und", 0.0)}


def test_stages(tables, spark, tmp_path):
    documents, labels, benchmark, _ = tables
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    for empty in (False, True):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            given = documents.limit(0) if empty else documents
            kept = stage(spark, given, str(tmp_path))
            assert kept.columns == documents.columns and kept.dtypes == documents.dtypes, name
            rows = kept.collect()
            assert not empty or not rows
            if not empty and name == "near duplicates":
                assert sorted(row.doc_id for row in rows) == [-7, 1, 3, 5, 6]
            if not empty and name == "benchmark passages":
                assert sorted(row.doc_id for row in rows) == [-7, 3, 4, 5, 6]
            if not empty and name == "repeated strings":
                texts = sorted((row.text or "") for row in rows if row.doc_id in (None, 1, 2))
                assert texts == ["", "", "", GOOD]
        mixed = corpus_pipeline.STAGES[-1][1](spark, given, str(tmp_path)).collect()
        assert len(mixed) == (0 if empty else len(DOCUMENTS))
        assert all((row.first_slot is None) == (row.taken == 0) for row in mixed)


def test_pipeline_on_odd_and_no_documents(tables, spark, tmp_path):
    documents, labels, benchmark, _ = tables
    for name, rows in (("odd", documents), ("none", documents.limit(0))):
        for table, frame in (("documents", rows), ("labels", labels), ("benchmark", benchmark)):
            frame.write.parquet(f"{tmp_path}/{name}/{table}.parquet")
        found = corpus_pipeline.run(spark, f"{tmp_path}/{name}")
        assert found.count() <= rows.count() and "taken" in found.columns


def test_many_rows_without_ids_spread_over_chunks(spark, monkeypatch):
    """Rows of one source that share an id, or have none, don't all stand in one chunk of the stream."""
    monkeypatch.setattr(mixing, "CHUNK_DOCS", 50)
    rows = [(None if n % 2 else 7, f"w{n} and more", "a") for n in range(1000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sized = mixing.sizes(frame)
    laid = mixing.streams(sized, mixing.targets(sized))
    starts = sorted(row.start for row in laid.collect())
    assert starts == list(range(0, 3000, 3))
    assert sum(row.taken for row in mixing.mix(frame).collect()) == int(1.5 * 3000)
