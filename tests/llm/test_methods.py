"""The operators against brute-force versions, round trips and held-out accuracy."""

import hashlib
import random
import re
import struct
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from beatlake.llm import html, langid, mixing, quality, rules, simhash, similar, substrings, toxicity, warc

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def texts_of(documents):
    return {row.doc_id: row.text or "" for row in documents.select("doc_id", "text").collect()}


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda match: match[0].lower(), text))
    shingles = [" ".join(words[at : at + 3]) for at in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(shingle.encode(), 42) for shingle in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(value >> bit & 1 for value in hashes) > len(hashes))


def brute_components(prints):
    """Component ids of {doc_id: fingerprint} by looking at every pair."""
    root = {doc: doc for doc in prints}

    def find(doc):
        while root[doc] != doc:
            doc = root[doc]
        return doc

    ordered = sorted(prints)
    for at, one in enumerate(ordered):
        for other in ordered[at + 1 :]:
            if (prints[one] ^ prints[other]).bit_count() <= 3:
                a, b = sorted((find(one), find(other)))
                root[b] = a
    return {doc: find(doc) for doc in prints}


def test_simhash_equals_all_pairs(documents):
    prints = {doc: brute_fingerprint(text) for doc, text in texts_of(documents).items()}
    wanted = brute_components(prints)
    for row in simhash.near_duplicates(documents).collect():
        assert (row.fingerprint, row.component_id) == (f"{prints[row.doc_id]:016x}", wanted[row.doc_id])


def test_simhash_links_in_blocks(spark):
    random.seed(3)
    centre = random.getrandbits(64)
    prints = {centre}
    for _ in range(120):
        prints.add(random.choice(sorted(prints)) ^ sum(1 << bit for bit in random.sample(range(64), random.randint(1, 4))))
    prints |= {random.getrandbits(64) for _ in range(40)}
    signed = {value: value - (1 << 64) if value >> 63 else value for value in prints}
    frame = spark.createDataFrame([(value,) for value in signed.values()], "fp long")
    wanted = brute_components(prints := {value: value for value in prints})
    for rows in (simhash.BLOCK_ROWS, 30):
        roots = {row.fp: row.root for row in simhash.connected(simhash.links(frame, rows)).collect()}
        groups = Counter(frozenset([roots.get(signed[value], signed[value])]) for value in prints)
        assert sorted(groups.values()) == sorted(Counter(wanted.values()).values())


@given(st.integers(0, 2**64 - 1), st.sets(st.integers(0, 63), max_size=3))
@settings(max_examples=300, deadline=None)
def test_every_near_pair_has_a_chain_and_a_key(value, bits):
    other = value ^ sum(1 << bit for bit in bits)
    difference = np.array([value ^ other], dtype=np.uint64)
    starts = [start for start in range(8) if simhash.chained(difference, start)[0]]
    assert starts

    def keys(number, start):
        ring = (number << 8 * start | number >> 64 - 8 * start) & (1 << 64) - 1
        return [(ring >> 48, ring >> 36 - 12 * half & 4095) for half in (0, 1)]

    assert any(a == b for start in starts for a, b in zip(keys(value, start), keys(other, start)))


def brute_kept(texts):
    """Least ids of groups connected by a 5-word Jaccard similarity of 0.8 or more, by looking at every pair."""
    sets, root = {}, {doc: doc for doc in texts}
    for doc, text in texts.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda match: match[0].lower(), text))
        sets[doc] = {tuple(words[at : at + 5]) for at in range(max(1, len(words) - 4))} if words else set()

    def find(doc):
        while root[doc] != doc:
            doc = root[doc]
        return doc

    ordered = sorted(texts)
    for at, one in enumerate(ordered):
        for other in ordered[at + 1 :]:
            if 5 * len(sets[one] & sets[other]) >= 4 * len(sets[one] | sets[other]):
                a, b = sorted((find(one), find(other)))
                root[b] = a
    return {doc for doc in texts if find(doc) == doc}


def test_near_duplicates_equal_all_pairs(spark, documents, monkeypatch):
    stage = dict(corpus_pipeline.STAGES)["near duplicates"]
    texts = texts_of(documents)
    kept = {row.doc_id for row in stage(spark, documents, SF).collect()}
    assert kept == brute_kept(texts) and not kept & {145, 177}  # copies of 6 and 1, 7 and 11 bits apart
    random.seed(7)
    words = [f"w{n}" for n in range(300)]
    line, texts, passage = random.sample(words, 6), {}, random.sample(words, 40)
    for n in range(160):
        own = list(passage) if n % 2 else random.sample(words, random.randint(0, 30))
        for _ in range(random.randint(0, 3)):
            if own:
                own[random.randrange(len(own))] = random.choice(words)
        texts[n] = " ".join(own + (line if n % 3 else []))
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    wanted = brute_kept(texts)
    assert {row.doc_id for row in similar.keep_one(frame).collect()} == wanted and 60 < len(wanted) < 150
    monkeypatch.setattr(similar.roots_of, "__defaults__", (5,))  # large keys in blocks
    assert {row.doc_id for row in similar.keep_one(frame).collect()} == wanted


def test_parts_of_a_key_meet_all_open_pairs():
    sizes, places, roots = np.full(50, 10), np.zeros(50, dtype=int), np.arange(50) // 2

    def pairs(blocks):
        return {(at, other) for at, found in similar.open_pairs(sizes, places, roots, blocks) for other in found.tolist()}

    wanted = {(a, b) for a in range(50) for b in range(a + 1, 50) if a // 2 != b // 2}
    assert pairs(np.zeros(50)) == wanted
    blocks = np.arange(50) % 3
    assert pairs(blocks) == {(a, b) for a, b in wanted if a % 3 != b % 3}


@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 5)), max_size=40), st.lists(st.integers(1, 7), min_size=1))
@settings(max_examples=200, deadline=None)
def test_shared_keys_in_batches_of_any_size(pairs, cuts):
    rows = sorted(pairs)
    batches, at = [], 0
    while at < len(rows):
        size = cuts[len(batches) % len(cuts)]
        part = rows[at : at + size]
        columns = [[key for key, _ in part], [name for _, name in part], [10] * len(part), [0] * len(part)]
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
        batches.append(pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds)], names=["key", "name", "size", "place"]))
        at += size
    found = {tuple(row[name] for name in ("key", "name", "pivot", "near")) for batch in similar._shared(iter(batches)) for row in batch.to_pylist()}
    wanted = set()
    for key in {key for key, _ in rows}:
        names = {name for own, name in rows if own == key}
        if len(names) > 1:
            wanted |= {(key, name, min(names), name != min(names)) for name in names}
    assert found == wanted


def test_rows_grow_no_faster_than_a_group(spark, monkeypatch):
    """Texts with some words changed: most pairs are just below the limit, so that no pivot joins them."""
    monkeypatch.setattr(similar, "MORE_PAIRS", 2)
    written = similar.Scratch.saved

    def kept_and_rows(n):
        random.seed(11)
        base = [f"w{at}" for at in range(400)]
        texts = {}
        for doc in range(n):
            own = list(base)
            for at in random.sample(range(400), 5):
                own[at] = f"x{doc}-{at}"
            texts[doc] = " ".join(own)
        rows = Counter()

        def counting(self, frame, name):
            out = written(self, frame, name)
            rows[name] += out.count()
            return out

        monkeypatch.setattr(similar.Scratch, "saved", counting)
        frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
        kept = {row.doc_id for row in similar.keep_one(frame).collect()}
        assert kept == brute_kept(texts)
        return kept, rows

    (kept, few), (_, many) = kept_and_rows(100), kept_and_rows(200)
    assert 0 < many["candidates-sketched"] <= similar.MORE_PAIRS * many["crowded"] and many["links-dense"]
    pairs = [name for name in many if name.startswith(("candidates", "pairs", "links"))]
    assert all(many[name] <= similar.FEW_PAIRS * many["open"] for name in pairs)
    more = {name: (few[name], rows) for name, rows in many.items() if name not in pairs and rows > 2.5 * few[name] + 100}
    assert not more


def brute_substrings(texts, length=100):
    seen, out = set(), {}
    for doc in sorted(texts):
        data = texts[doc]
        cut = bytearray(len(data))
        for at in range(len(data) - length + 1):
            if data[at : at + length] in seen:
                cut[at : at + length] = b"\1" * length
            seen.add(data[at : at + length])
        kept = bytes(byte for byte, gone in zip(data, cut) if not gone)
        spans = sum(1 for at, gone in enumerate(cut) if gone and not (at and cut[at - 1]))
        out[doc] = (len(data), sum(cut), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("large_bucket", [substrings.LARGE_BUCKET, 1])
def test_substrings_equal_all_windows(spark, large_bucket):
    random.seed(5)
    passage = " ".join(random.choice(["alpha", "beta", "gamma", "delta", "x"]) + str(random.randint(0, 99)) for _ in range(60))
    texts = {n: "".join(random.choice("ab cdé") for _ in range(random.randint(0, 400))) for n in range(40)}
    for n in range(0, 40, 3):
        at = random.randint(0, 100)
        texts[n] += passage[at : at + random.randint(90, 300)] + texts[(n + 7) % 40]
    texts |= {50: "z" * 450, 51: "zy" * 180, 52: passage * 3, 53: texts[3], 54: "a" * 99, 55: "a" * 100, 56: "a" * 100}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    wanted = brute_substrings({doc: text.encode() for doc, text in texts.items()})
    found = {row[0]: tuple(row[1:]) for row in substrings.without_repeats(frame, large_bucket).collect()}
    assert found == wanted


@given(st.lists(st.binary(min_size=100, max_size=160), min_size=1, max_size=6), st.integers(1, 3))
@settings(max_examples=60, deadline=None)
def test_bucket_pointers_tell_windows_apart(texts, letters):
    texts = [bytes(byte % letters for byte in text) for text in texts]
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    pointers = substrings.refined(data, np.array([len(text) for text in texts]))
    windows = [text[at : at + 100] for text in texts for at in range(len(text) - 99)]
    assert len(pointers) == len(windows)
    assert len(set(zip(pointers.tolist(), windows))) == len(set(pointers.tolist())) == len(set(windows))


def brute_statistics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[at : at + 3]) for at in range(len(words) - 2))
    covered = {at + k for at in range(len(words) - 2) if windows[tuple(words[at : at + 3])] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (
        len(words), sum(map(len, words)), sum(text.count(mark) for mark in rules.SYMBOLS), len(lines) - len(set(lines)), len(covered)
    )


def test_rules_equal_brute_force(documents, labels):
    texts = texts_of(documents)
    rated = rules.with_statistics(documents.select("doc_id", "text")).drop("text")
    learned = rules.learn(rated, labels)
    numbers = {row.doc_id: row.asDict() for row in rated.collect()}
    for row in rules.rate(documents, labels).collect():
        counts = brute_statistics(texts[row.doc_id])
        assert tuple(row[1:6]) == counts
        failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        assert (row.base_failed, row.kept) == (failed, not failed and learned.keep(numbers[row.doc_id]))


def test_rules_find_planted_conditions(spark):
    random.seed(1)
    words = [f"w{n}" for n in range(400)]
    rows = []
    for n in range(300):
        text = " ".join(random.sample(words, 80))
        rows.append((n, text.replace("w1", "w1###") if n % 3 == 0 else text, int(n % 3 != 0)))
    frame = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    kept = rules.rate(frame.drop("quality"), frame.select("doc_id", "quality")).join(frame.select("doc_id", "quality"), "doc_id").collect()
    assert all(row.kept == bool(row.quality) for row in kept)


def test_mix_reaches_targets_in_any_order(documents):
    once = sorted(map(tuple, mixing.mix(documents).collect()))
    again = sorted(map(tuple, mixing.mix(documents.repartition(7).orderBy("n_chars")).collect()))
    assert once == again
    taken = Counter()
    for _, source, _, _, target, words, _ in once:
        taken[source, target] += words
    assert all(words == int(target) for (_, target), words in taken.items())


def test_any_stretch_of_the_mix_has_its_shares(spark):
    """Slots of a source among the first n differ from its share of n by no more than the golden-ratio points allow."""
    rows = [(n, "w " * 64, f"s{n % 4}" if n % 5 else "big") for n in range(6000)]
    sized = mixing.sizes(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    sources = mixing.targets(sized).collect()
    frame = spark.createDataFrame(sources)
    blocks = mixing.schedule(frame, block=64).where("slot is not null")
    total = sum(row.target for row in sources)
    for row in sources:
        slots = sorted(x.slot for x in blocks.where(F.col("ix") == row.ix).collect())
        epochs = row.target / row.source_size
        for place, slot in enumerate(slots):
            # Each block is counted by its first slot, so the count is that of the first epoch.
            assert place + 1 <= (slot + 1) * row.target / total + 4 * np.log(slot + 2) + 1
        assert len(slots) == min(1, epochs) * row.source_size // 64 or abs(len(slots) - min(1, epochs) * row.source_size / 64) <= 1
    taken = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), block=64)
    first = taken.where("first_slot is not null").orderBy("first_slot").limit(800).groupBy("source").count().collect()
    wanted = {row.source: row.target / total for row in sources}
    assert all(abs(row["count"] / 800 - wanted[row.source]) < 0.05 for row in first)


def accuracy(rows, truth):
    held = [row for row in rows if row.held_out and row.doc_id in truth]
    return sum(row.predicted == truth[row.doc_id] for row in held) / len(held)


def test_classifiers_on_held_out_rows(spark):
    documents = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    truth = labels.collect()
    few = documents.join(labels.select("doc_id"), "doc_id")
    assert accuracy(quality.judged(few, labels).collect(), {row.doc_id: row.quality for row in truth}) > 0.97
    assert accuracy(toxicity.judged(few, labels).collect(), {row.doc_id: row.toxic for row in truth}) > 0.95


def test_language_on_held_out_rows(documents):
    truth = {row.doc_id: row.lang for row in documents.collect()}
    held = [row for row in langid.judged(documents).collect() if row.held_out]
    assert sum(row.lang_pred == truth[row.doc_id] for row in held) > 0.95 * len(held)


def test_a_language_of_long_texts_is_learned(spark):
    french, german = "le chat est sur la table et il dort ", "der hund liegt unter dem tisch und er bellt "
    rows = [(n, french * 4000, "fr") for n in range(40)] + [(n, french * 2, "fr") for n in range(40, 44)]
    rows += [(n, german * 3, "de") for n in range(100, 160)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sample = langid.sampled(frame, F.lit(True), 4)
    assert sorted(lang for _, lang in sample) == ["de"] * 4 + ["fr"] * 4
    assert all(len(text) <= langid.SAMPLE_BYTES for text, _ in sample)
    found = langid.identify(frame, F.lit(True), 4).collect()
    assert all(row.lang_pred == ("fr" if row.doc_id < 100 else "de") for row in found)


def test_a_class_of_long_texts_is_learned(spark):
    rows = [(n, ("good plain words " if n % 2 else "bad ugly lines ") * 30_000) for n in range(20)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(n, n % 2) for n in range(20)], "doc_id long, quality int")
    found = quality.judged(frame, labels).collect()
    assert all(row.predicted == row.doc_id % 2 for row in found)


def test_gradients_of_the_recurrent_network():
    model = langid.learn([(b"abc de fgh", "x"), (b"klm no pqr", "y")], steps=0)
    words, truth, weights = [b"abc", b"kl\xc3"], np.array([0, 1]), np.ones(2, dtype=np.float32)

    def loss():
        return -sum(np.log(model.labels([word])[0][:, lang]).sum() for word, lang in zip(words, truth)) / 6

    gradients = langid._gradients(model, words, truth, weights)
    for matrix, gradient in zip(model.matrices(), gradients):
        place = np.unravel_index(np.abs(gradient).argmax(), gradient.shape)
        before = matrix[place]
        matrix[place] = before + 1e-2
        up = loss()
        matrix[place] = before - 1e-2
        down = loss()
        matrix[place] = before
        assert abs((up - down) / 2e-2 - gradient[place]) < 0.05 * abs(gradient[place]) + 1e-3


def test_warc_files_round_trip(spark, tmp_path):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    doubled = pages.unionByName(pages.withColumn("page_id", F.col("page_id") + 1_000_000).where("page_id % 3 = 0"))
    warc.write_archives(doubled, archive_bytes=20_000, folder=str(tmp_path))
    files = sorted(tmp_path.glob("*.warc.zst"))
    wanted = {row.page_id: (row.url, row.html) for row in doubled.collect()}
    records = [record for path in files for record in warc.read_archive(path.read_bytes())]
    assert len(records) == len(wanted) and len(files) > 1 and not list((tmp_path / "_work").glob("*.zst"))
    by_id = {record.page_id: record for record in records}
    for page, (url, text) in wanted.items():
        record = by_id[page]
        body = record.payload if record.payload is not None else by_id[record.refers_to].payload
        assert (record.url, body) == (url, text.encode()) and record.digest == hashlib.sha256(body).hexdigest()
    content = files[0].read_bytes()
    magic, size = struct.unpack_from("<II", content)
    assert magic == warc.DICTIONARY_MAGIC and size > 0
    damaged = bytearray(warc.record_bytes(warc.Record(1, None, b"text", 4, hashlib.sha256(b"text").hexdigest())))
    damaged[-6] ^= 1
    with pytest.raises(ValueError):
        warc.parse_record(bytes(damaged))


def test_pages_without_an_article(spark):
    page = (
        "<html><body><div class='top-menu'><a href=x>Home</a></div><div class=story><p>{0}</p><p>Follow us today</p></div>"
        "<div><a href=1>Link one</a> <a href=2>Link two</a></div><section id=comments><p>Me too</p></section>"
        "<form>Name <input></form><div hidden>secret</div><script>if (a < b) '<p>'</script></body></html>"
    )
    rows = [(n, f"http://news.example/{n}", page.format(f"Story number {n}, with  white\n space &lt;here&gt; ")) for n in range(6)]
    found = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {row.page_id: row.text for row in found} == {n: f"Story number {n}, with white space <here>" for n in range(6)}


def test_copies_of_an_article_are_no_template(spark):
    def page(host, n, *paragraphs):
        text = "".join(f"<p>{paragraph}</p>" for paragraph in paragraphs)
        return n, f"http://{host}.example/{n}", f"<html><body><article><h1>Title</h1>{text}</article></body></html>"

    body = [f"paragraph {n} of the body, which all copies of this article share" for n in range(8)]
    own = [f"a text of its own number {n}, longer than what stands below it" for n in range(100)]
    rows = [page("two", n, body[0], own[n]) for n in range(2)]
    rows += [page("crawled", n, *body, f"edited {n}") for n in range(10, 12)]
    rows += [page("hot", n, *body[:4], f"edited {n}", *body[4:], "Follow us") for n in range(20, 60)]
    rows += [page("hot", n, own[n], "Follow us") for n in range(60, 70)]
    rows += [page("copies", n, *body, f"edited {n}") for n in range(70, 90)]
    found = {row.page_id: row.text.split("\n")[1:] for row in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(found[n] == [body[0], own[n]] for n in range(2))
    assert all(found[n] == [*body, f"edited {n}"] for n in [10, 11, *range(70, 90)])
    assert all(found[n] == [*body[:4], f"edited {n}", *body[4:]] for n in range(20, 60))
    assert all(found[n] == [own[n]] for n in range(60, 70))


def test_trees_are_matched_in_order():
    assert html.simple_tree_matching("(a(b,c(d)),e)", "(a(c(d),f),e)") == {0: 0, 1: 1, 3: 2, 4: 3, 5: 5}
    assert html.Page("<div>" * 5000 + "deep").blocks[0][1] == "deep"


def test_elements_deeper_than_the_skeleton():
    blocks = html.Page("<div><article>" + "<div>" * 250 + "body" + "</div>" * 250 + "<p>tail</p></article></div>").blocks
    assert [(block[1], block[4]) for block in blocks] == [("body", True), ("tail", True)]
    page = html.Page("<section>" * 300 + "text<nav>menu</nav><script>'x'</script><p>more</p><footer>rights</footer>" + "<b>" * 300 + "<nav>menu</nav>")
    assert html.main_text(page, page.skeleton(), set()) == "text\nmore"
    assert max(page._depth) == html.MAX_DEPTH
    assert len(html.Page("<div><li>x</b></i>" * 20_000 + "</span>" * 20_000).blocks) == 20_000  # in linear time


def test_names_that_say_something_else_and_comments():
    page = html.Page(
        "<article><p>Body</p><div class='restaurant-menu'>Soup</div><section class='related-work'>Earlier</section>"
        "<div class='social-history'>1848</div><div id='comments-on-the-law'>Law</div><p>Please <span class='share'>share</span> it</p>"
        "<div class='share-buttons'>Tweet</div><div class='top-menu'>Home</div><article class='comment'>Me too</article>"
        "<section id='comments'>So <b>do</b> I</section><div class='ad'>Buy</div><p>End</p></article><article class='comment'>Reader says</article>"
    )
    assert html.main_text(page, page.skeleton(), set()) == "Body\nSoup\nEarlier\n1848\nLaw\nPlease share it\nEnd"


@pytest.mark.parametrize("part", ["<a ", '<p class="a" ', "x<y ", '<a ">" ', "<!-- ", "</b ", "<p>a<", "'<i \""])
def test_unclosed_marks_take_linear_time(part):
    for end in ("", ">", '">', "-->"):
        began = time.process_time()
        html.Page(part * (1_000_000 // len(part)) + end)
        assert time.process_time() - began < 10


def test_unclosed_comments_hide_the_rest():
    assert [block[1] for block in html.Page("<p>a</p>b <!-- c").blocks] == ["a", "b"]
    assert [block[1] for block in html.Page("<p>a</p>b <!-- <p>c</p> d").blocks] == ["a", "b"]


def test_pipeline_equals_its_stages(spark, documents, labels):
    """The kept documents by brute force: rules as learned, one of each group, no repeated strings, no benchmark."""
    docs, after = documents, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        after[name] = texts_of(docs)
    texts = texts_of(documents)
    kept = {row.doc_id for row in rules.rate(documents, labels).where("kept").collect()}
    assert after["quality rules"] == {doc: texts[doc] for doc in kept}
    first = brute_kept({doc: texts[doc] for doc in kept})
    assert after["near duplicates"] == {doc: texts[doc] for doc in first} and len(first) < len(kept)
    wanted = brute_substrings({doc: text.encode() for doc, text in after["near duplicates"].items()})
    for doc, text in after["repeated strings"].items():
        size, cut, *_ = wanted[doc]
        assert size - cut - 3 * wanted[doc][2] * 2 <= len(text.encode()) <= size - cut
    windows = set()
    for row in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda match: match[0].lower(), row.text or ""))
        windows |= {tuple(words[at : at + 13]) for at in range(max(1, len(words) - 12))} if words else set()
    for doc, text in after["repeated strings"].items():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda match: match[0].lower(), text))
        hit = {at + k for width in {len(w) for w in windows} for at in range(len(words)) if tuple(words[at : at + width]) in windows for k in range(width)}
        assert (doc in after["benchmark passages"]) == (not (hit and 20 * len(hit) >= len(words)))
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {row.doc_id for row in mixed} == set(after["benchmark passages"])


def test_toxicity_learns_from_every_labelled_row(spark, monkeypatch):
    """A mark that no text of the starting sample has is learned, and rows set aside beyond the sample calibrate."""
    plain, common, rare = "calm plain words here ", "awful nasty words here ", "vile rotten words here "
    ids = spark.createDataFrame([(n,) for n in range(0, 600, 3)], "doc_id long").withColumn("turn", F.xxhash64("doc_id"))
    first = {row.doc_id for row in ids.orderBy("turn").limit(8).collect()}  # the toxic rows of the sample
    documents = [(n, plain if n % 3 else common if n in first else rare, "en" if n % 2 else "fr") for n in range(600)]
    frame = spark.createDataFrame([*documents, (900, rare, "en"), (901, plain, "en")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(n, int(n % 3 == 0)) for n in range(600)], "doc_id long, toxic int")
    sample = toxicity.labelled_sample(frame, labels, "toxic", 8, F.lit(True))
    assert not any(text == rare.encode() for _, text, label in sample)
    monkeypatch.setattr(toxicity, "SHARD_ROWS", 100)
    found = {row.doc_id: row for row in toxicity.score_toxicity(frame, labels, F.lit(True), 8).collect()}
    assert found[900].score >= 0.5 > found[901].score


def test_pools_of_blocks_name_the_places_that_won():
    model = toxicity.learn([b"good words", b"bad words"], [0, 1])
    rows = toxicity.rows_of(b" ".join(b"w%d" % (n * n % 977) for n in range(500)), toxicity.new_codes())
    values, places = model.pooled(model.embedded(rows))
    before, toxicity.TASK_WORDS = toxicity.TASK_WORDS, 64
    try:
        blocks, found = model.pooled_whole(rows)
    finally:
        toxicity.TASK_WORDS = before
    assert np.allclose(values, blocks) and np.array_equal(np.stack(places), found)


def test_near_duplicates_write_no_table_of_all_prefixes(spark, monkeypatch):
    written = []
    saved = similar.Scratch.saved
    monkeypatch.setattr(similar.Scratch, "saved", lambda self, frame, name: written.append(name) or saved(self, frame, name))
    rows = [(n, " ".join(f"w{n // 2}x{at}" for at in range(30))) for n in range(20)]
    kept = similar.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(row.doc_id for row in kept) == list(range(0, 20, 2))
    assert "members" in written and "prefixes" not in written


def test_stages_leave_no_copy_of_the_texts(spark, monkeypatch):
    """What the rules and the repeated strings write beside their result are numbers, and a text is shuffled once."""
    written = []

    def noting(module):
        saved = module.saved
        monkeypatch.setattr(module, "saved", lambda frame, name, *path: written.append((name, frame.columns)) or saved(frame, name, *path))

    noting(rules)
    noting(substrings)
    rows = [(n, " ".join(f"w{n}x{at}" for at in range(80)) + " and a line that all of these texts share" * 5, n, n % 2 == 0) for n in range(20)]
    rows[7] = (7, None, 7, False)
    frame = spark.createDataFrame([*rows, (20, "few words", 9, True)], "doc_id long, text string, `a.b` long, flag boolean")
    labels = spark.createDataFrame([(n, 1) for n in range(20)], "doc_id long, quality int")
    good = rules.keep_good(frame, labels)
    assert good.columns == frame.columns and {row.doc_id for row in good.collect()} == set(range(20)) - {7}
    assert ["rules-statistics", "rules-labelled"] == [name for name, _ in written]
    assert not any("text" in columns for _, columns in written)
    cut = substrings.cut_repeats(frame)
    assert cut.schema.simpleString() == frame.schema.simpleString() and cut.count() == 21
    found = {row.doc_id: row for row in cut.collect()}
    assert found[7].text is None and found[20].text == "few words" and len(found[3].text) < len(rows[3][1]) - 100
    assert found[0].text.startswith("w0x0 ") and (found[8]["a.b"], found[8].flag, found[9].flag) == (8, True, False)
    assert cut._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1
    assert written[2:] == []


def test_near_duplicates_read_the_texts_of_open_pairs_once(spark, monkeypatch):
    """Few pairs of some parts and the pairs that sketches leave in others are decided together, dense parts by themselves."""
    monkeypatch.setattr(similar, "FEW_PAIRS", 0)
    written = []
    saved = similar.Scratch.saved
    monkeypatch.setattr(similar.Scratch, "saved", lambda self, frame, name: written.append(name) or saved(self, frame, name))
    random.seed(3)
    base, texts = [f"w{at}" for at in range(400)], {}
    for doc in range(60):
        own = list(base)
        for at in random.sample(range(400), 5):
            own[at] = f"x{doc}-{at}"
        texts[doc] = " ".join(own)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {row.doc_id for row in similar.keep_one(frame).collect()} == brute_kept(texts)
    assert "candidates-sketched" in written and [name for name in written if name.startswith("pairs")] == ["pairs-first", "pairs-second"]


def test_shares_of_anchors_equal_all_at_once(spark, monkeypatch):
    words = [f"word{n % 37}" for n in range(400)]
    frame = spark.createDataFrame([(n, " ".join(words[n * 5 : n * 5 + 90])) for n in range(40)], "doc_id long, text string")
    written = []
    saved = substrings.Scratch.saved
    monkeypatch.setattr(substrings.Scratch, "saved", lambda self, frame, name: written.append(name) or saved(self, frame, name))
    found = {row[0]: tuple(row[1:]) for row in substrings.without_repeats(frame).collect()}
    assert found == brute_substrings({row.doc_id: row.text.encode() for row in frame.collect()})
    assert "hits" not in written and sum(name.startswith("hits-") for name in written) == substrings.SHARES > 1
