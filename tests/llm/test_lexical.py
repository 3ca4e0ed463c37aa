"""Ranked search against plain integers, with ties, blocks, tiles and weights near the limit of exact products."""

import random
import re
from collections import Counter
from math import floor, log

import numpy as np
import pytest
from pyspark.sql import functions as F

from beatlake.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda match: match[0].lower(), text or ""))


def brute(documents, items, top=20):
    counted = [(doc, Counter(terms(text))) for doc, text in documents]
    counted = [(doc, found, found.total()) for doc, found in counted if found]
    big_n, big_l = len(counted), sum(n for _, _, n in counted)
    df = Counter(term for _, found, _ in counted for term in found)
    out = []
    for item, text in items:
        scores = []
        for doc, found, n in counted:
            m = 100 - 25 + (25 * n * big_n) // big_l
            score = sum(
                times * floor(1000 * log((2 * big_n + 2) / (2 * df[term] + 1))) * (10**9 * found[term] // (1000 * found[term] + 12 * m))
                for term, times in Counter(terms(text)).items() if term in found
            )
            if score > 0:
                scores.append((-score, doc is None, doc or 0))
        out += [(item, rank, None if none else doc, -score) for rank, (score, none, doc) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=repr)


def made_up():
    random.seed(9)
    words = [f"wört{n}" if n % 3 else f"W{n}" for n in range(80)] + ["中文", "a_b", "x'y", "9"]
    documents = [(n, " ".join(random.choices(words, k=random.randint(0, 40)))) for n in range(200)]
    documents += [(n + 1000, documents[n % 7][1]) for n in range(60)]  # ties beyond the last rank
    documents += [(5, None), (None, "W3 w6, W9"), (None, "W3 w6, W9"), (6, "word " * 500_000 + "W3"), (7, "...")]
    items = [(n, " ".join(random.choices(words, k=random.randint(0, 12)))) for n in range(300)]
    items += [(1, items[1][1]), (None, "W3"), (900, None), (901, ""), (902, "nowhere"), (903, "w3 " * 400_000 + "W6")]
    return documents, items


def rows_of(frame):
    return sorted(map(tuple, frame.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


@pytest.mark.parametrize("block_bytes", [lexical.BLOCK_BYTES, 2000])
def test_search_equals_plain_integers(spark, block_bytes, monkeypatch):
    documents, items = made_up()
    if block_bytes == 2000:  # many blocks; the one long item is tested above
        items = items[:60]
        monkeypatch.setattr(lexical, "DOCUMENT_TILE", 7)
    docs = spark.createDataFrame(documents, "doc_id long, text string").withColumns({"item": F.lit(1), "score": F.lit("x")}).repartition(7)
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(2))
    assert rows_of(lexical.search(docs, asked, block_bytes=block_bytes)) == brute(documents, items)


def test_nothing_to_find(spark):
    documents, items = made_up()
    docs = spark.createDataFrame(documents[:9], "doc_id long, text string")
    asked = spark.createDataFrame(items[:9], "item_id long, text string")
    for one, other in ((docs.limit(0), asked), (docs, asked.limit(0)), (docs.withColumn("text", F.lit("!")), asked)):
        found = lexical.search(one, other)
        assert found.columns == ["item_id", "rank", "doc_id", "score"] and not found.count()


def test_tiles_keep_products_exact():
    wanted = {item: {code: 1 + 5_000_000 * (code == 3) for code in range(item, 3000)} for item in range(3)}
    weight = np.full(3000, 27_000)
    (tile,) = lexical.tiles_of(wanted, weight)
    total = np.zeros((3000, 3), dtype=np.int64)
    for codes, weights in tile.parts:
        assert len(codes) <= lexical.TERM_TILE and (weights.sum(axis=0) * lexical.IMPACT_BELOW < 2**53).all()
        total[codes] += weights.astype(np.int64)
    assert all(total[code, item] == 27_000 * times for item in wanted for code, times in wanted[item].items())
