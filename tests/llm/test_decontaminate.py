"""The word automaton against all windows of all items, in one block and in many."""

import random

import pytest

from beatlake.llm import decontaminate
from beatlake.llm.decontaminate import NORMAL, Scanner


def brute(items, words, width=13):
    hit, ids = set(), set()
    for item, text in items:
        own = text.translate(NORMAL).split()
        if not own:
            continue
        windows = {tuple(own[at : at + width]) for at in range(max(1, len(own) - width + 1))}
        size = len(next(iter(windows)))
        for at in range(len(words) - size + 1):
            if tuple(words[at : at + size]) in windows:
                hit.update(range(at, at + size))
                ids.add(item)
    return hit, ids


def made_up(trial):
    random.seed(trial)
    letters = [b"a", b"b", b"c", b"dd"][: random.randint(1, 4)]
    items = [(f"i{n}", b" ".join(random.choices(letters, k=random.randint(0, 30)))) for n in range(6)]
    words = random.choices([*letters, b"z"], k=random.randint(0, 60))
    for _ in range(2):
        own = random.choice(items)[1].split()
        if own and words:
            at, begin = random.randrange(len(words)), random.randrange(len(own))
            words[at:at] = own[begin : begin + random.randint(5, 20)]
    return items, words


@pytest.mark.parametrize("width", [13, 3, 2, 1])
def test_scanner_equals_all_windows(width):
    for trial in range(150):
        items, words = made_up(trial)
        ranges, ids = Scanner(items, width).hits(words)
        assert ({at for first, end in ranges for at in range(first, end)}, ids) == brute(items, words, width)


def test_long_items_and_texts_take_linear_time():
    item = [b"w%d" % (n % 5000) for n in range(200_000)]
    scanner = Scanner([("long", b" ".join(item)), ("same", b" ".join([b"x"] * 3000))])
    assert scanner.hits(item)[0] == [(0, 200_000)] and scanner.hits([b"x"] * 5000)[0] == [(0, 5000)]


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_blocks_equal_one_automaton(spark, block_bytes):
    rows, wanted = [], {}
    items = [(n, " ".join(random.Random(n).choices("abcdef", k=n + 2))) for n in range(30)]
    given = [(str(n), text.encode()) for n, text in items]
    for doc in range(40):
        own = random.Random(doc)
        words = own.choices("abcz", k=20) + items[own.randrange(30)][1].split() + own.choices("xyz", k=5)
        rows.append((doc, " ".join(words)))
        hit, ids = brute(given, [word.encode() for word in words])
        wanted[doc] = (len(words), len(hit), len(ids), bool(hit) and 20 * len(hit) >= len(words))
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.judge(documents, benchmark, block_bytes=block_bytes).collect()
    assert {row.doc_id: (row.n_words, row.n_hit, row.n_items, row.contaminated) for row in found} == wanted
