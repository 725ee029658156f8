"""FM-index against scans, and documents' hits against brute force."""

import random

import numpy as np
import pytest

from subtide.llm import decontaminate as dc
from subtide.llm.fm_index import FMIndex, WaveletMatrix, suffix_array


@pytest.mark.parametrize("n, letters", [(1, 3), (10, 2), (1000, 2), (3000, 50), (2000, 1)])
def test_index(n, letters):
    rng = np.random.default_rng(n + letters)
    text = rng.integers(1, letters + 1, n)
    listed = [*text.tolist(), 0]
    assert suffix_array(np.append(text, 0)).tolist() == sorted(range(n + 1), key=lambda i: listed[i:])
    wavelet = WaveletMatrix(text)
    at = rng.integers(0, n + 1, 50)
    symbol = rng.integers(1, letters + 1, 50)
    assert wavelet.rank(symbol, at).tolist() == [listed[:a].count(s) for a, s in zip(at.tolist(), symbol.tolist())]
    phrases = [listed[i: i + 10] for i in rng.integers(0, n, 20)] + [rng.integers(1, letters + 3, 3).tolist() for _ in range(20)]
    phrases = [[s for s in p if s] for p in phrases]
    grid = np.zeros((len(phrases), 10), dtype=np.int64)
    for row, phrase in zip(grid, phrases):
        row[10 - len(phrase):] = phrase
    index = FMIndex(text)
    low, high = index.intervals(grid, np.array([len(p) for p in phrases]))
    for a, b, phrase in zip(low, high, phrases):
        places = [i for i in range(n - len(phrase) + 1) if listed[i: i + len(phrase)] == phrase]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == places


def brute(text, windows):
    words, cover, items = dc.words_of(text), set(), set()
    for size in {len(w) for w in windows}:
        for a in range(len(words) - size + 1):
            owners = windows.get(tuple(words[a: a + size]))
            if owners:
                items |= owners
                cover.update(range(a, a + size))
    return len(words), len(cover), sorted(items)


def windows_of(items, size=10):
    out = {}
    for item, text in items:
        words = dc.words_of(text)
        for a in range(max(1, len(words) - size + 1) if words else 0):
            out.setdefault(tuple(words[a: a + size]), set()).add(item)
    return out


def test_random_texts_with_short_and_shared_items():
    rng = random.Random(4)
    vocabulary = "a b c d".split()
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(str(i), say(rng.choice((1, 3, 9, 10, 14)))) for i in range(30)] + [("30", ""), ("31", "?!"), ("32", "q Q-q")]
    texts = [say(rng.randint(0, 60)) + rng.choice(("", " other ", ". Z z")) + say(rng.randint(0, 30)) for _ in range(60)] + [None, "", "q,q;Q"]
    for some in (items, items[:0], [("x", "?")], [i for i in items if len(i[1].split()) >= 10]):
        n, spans, found = dc.Phrases(some).search(texts)
        expected = [brute(t, windows_of(some)) for t in texts]
        assert [(int(a), sum(y - x for x, y in b), c) for a, b, c in zip(n, spans, found)] == expected


def test_tables(spark, small, odd, none, monkeypatch):
    benchmark = small("benchmark")
    items = [(str(r.item_id), r.text) for r in benchmark.collect()]
    docs = small("documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for group_bytes in (32 << 20, 600):  # one group of items, and several
        monkeypatch.setattr(dc, "GROUP_BYTES", group_bytes)
        for r in dc.find_passages(docs, benchmark).collect():
            n, hit, found = brute(texts[r.doc_id], windows_of(items))
            assert (r.n_words, sum(s.b - s.a for s in r.spans), r["items"]) == (n, hit, found)
    assert dc.find_passages(odd, benchmark).count() == odd.count()
    assert dc.find_passages(none, benchmark).collect() == []
    assert {r.n_words for r in dc.find_passages(odd, benchmark.limit(0)).filter("doc_id IN (2, 3, 4)").collect()} == {0}
    nulls = spark.createDataFrame([(None, "the quick brown fox"), (1, None), (1, "?")], "item_id long, text string")
    assert [r["items"] for r in dc.find_passages(odd, nulls).filter("doc_id = 1").collect()] == [[""]]


def test_removal(spark):
    item = "one two three four five six seven eight nine ten eleven"
    docs = spark.createDataFrame([
        (1, f"Before, {item.upper()}! After.", "k"), (2, item, "k"), (3, "nothing of it", "k"), (4, None, "k"), (5, "", "k"), (6, "?!", "k"),
        (7, f"one two three four {item} five six seven eight nine ten eleven tail", "k"),
    ], "doc_id long, text string, items string")
    found = {r.doc_id: r.text for r in dc.remove_passages(docs, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()}
    assert found == {1: "Before, \n! After.", 3: "nothing of it", 4: None, 5: "", 6: "?!", 7: "\n tail"} or found[7].split() == ["tail"]
    assert 2 not in found


def test_removal_does_not_depend_on_groups(spark, monkeypatch):
    words = [f"w{i}" for i in range(40)]
    say = lambda a, b: " ".join(words[a:b])
    # windows that overlap, windows that close over another item's cut, and short items
    items = [say(0, 10), say(5, 15), say(20, 32), say(28, 40), say(16, 19), "x y"]
    texts = [
        f"head {say(0, 15)} tail", f"head {say(20, 40)} tail", say(0, 15), f"head {say(0, 4)} {say(16, 19)} {say(4, 10)} tail",
        f"head {say(20, 25)} {say(28, 33)} x y {say(33, 40)} {say(25, 32)} tail", f"x {say(5, 9)} {say(0, 10)} {say(9, 15)} y", "none of it", None, "?!", "x",
    ]
    rows = [(i % 8, t, "k") for i, t in enumerate(texts)] + [(0, texts[0], "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string").repartition(3)
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = []
    for group_bytes in (32 << 20, 200, 60):
        monkeypatch.setattr(dc, "GROUP_BYTES", group_bytes)
        cleaned = dc.remove_passages(docs, benchmark)
        assert cleaned.columns == docs.columns
        found.append(sorted(map(tuple, cleaned.collect()), key=repr))
    assert found[0] == found[1] == found[2]
    assert {t.split()[-1] for _, t, _ in found[0] if t and t.startswith("head")} == {"tail"} and len(found[0]) == 9
    assert [t.split() for _, t, _ in found[0] if t and t.startswith("head")] == [["head", "tail"]] * 5
    windows = windows_of([(str(i), t) for i, t in enumerate(items)])
    assert not any(brute(t, windows)[1] for _, t, _ in found[0])


@pytest.mark.parametrize("group_bytes, stretch", [(1 << 20, 1 << 20), (1 << 20, 40), (2000, 40), (1000, 1 << 20)])
def test_long_items_are_taken_in_stretches(spark, monkeypatch, group_bytes, stretch):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(12)] + ["Ä", "LONGER-word"]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(str(i), say(n)) for i, n in enumerate((3, 10, 11, 19, 20, 21, 60, 300))] + [("7", say(30)), ("8", "?" * 90), ("1", None)]
    items += [items[6], items[6], ("one more", items[6][1])]
    pick = lambda t, n: " ".join(t.split()[n: n + rng.randint(8, 25)])
    texts = [f"{say(4)} {pick(rng.choice(items[:8])[1], rng.randrange(40))} {say(5)}" for _ in range(40)] + [items[7][1], items[3][1], None, "", "?"]
    monkeypatch.setattr(dc, "GROUP_BYTES", group_bytes)
    monkeypatch.setattr(dc, "STRETCH_BYTES", stretch)
    benchmark = spark.createDataFrame(items, "item_id string, text string").repartition(3)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    kept = dc._Items(benchmark, "item_id", "text", 10)
    assert (kept.groups > 1) == (group_bytes < 1 << 20)
    if stretch == 40:
        groups = [kept.shared(g).value[1] for g in range(kept.groups)]
        assert all(sum(len(t.encode()) + 50 for _, t in g) <= 2 * max(group_bytes, stretch) or len(g) == 1 for g in groups)
    windows = windows_of([(i, t) for i, t in items if t])
    found = dc.find_passages(docs, benchmark).collect()
    assert len(found) == len(texts)
    for r in found:
        assert (r.n_words, sum(s.b - s.a for s in r.spans), r["items"]) == brute(texts[r.doc_id], windows)
    cleaned = {r.doc_id: r.text for r in dc.remove_passages(docs, benchmark).collect()}
    assert not any(brute(t, windows)[1] for t in cleaned.values())
    for i, t in enumerate(texts):  # texts without hits stay
        if not brute(t, windows)[1]:
            assert cleaned[i] == t
