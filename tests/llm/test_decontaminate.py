import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from coverlay.llm import decontaminate as D
from tests.conftest import DATA


def distance_within(pattern, text):
    """Fewest edits from the whole pattern to any part of the text, by the full table."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        above, row[0] = row[:], i
        for j in range(1, len(text) + 1):
            row[j] = min(above[j - 1] + (c != text[j - 1]), above[j] + 1, row[j - 1] + 1)
    return min(row)


def letters(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(n))


def edited(rng, text, n):
    x = list(text)
    for _ in range(n):
        p = rng.randrange(len(x))
        kind = rng.randrange(3)
        if kind == 0:
            x[p] = rng.choice("klmnop")
        elif kind == 1:
            del x[p]
        else:
            x.insert(p, rng.choice("klmnop"))
    return "".join(x)


@pytest.mark.parametrize("seed", range(3))
def test_every_region_within_budget_is_found(seed):
    """Brute force by windows: whatever is within the budget must be found, whatever is found must be within it."""
    rng, how = random.Random(seed), D.Matching()
    items = [(i, letters(rng, rng.choice((7, 12, 20)))) for i in range(6)]
    patterns = D.Patterns(items, how)
    for _ in range(3):
        item, text = rng.choice(items)
        passage = edited(rng, text, rng.randrange(0, 10))
        doc = letters(rng, rng.randrange(0, 15)) + " " + passage + " " + letters(rng, rng.randrange(0, 15))
        found = {f[0]: f for f in D.find(doc, patterns)}
        codes = D.normalise(doc)[0].tolist()
        for i, body in items:
            pattern = D.normalise(body)[0].tolist()
            if len(pattern) < how.least:
                assert i not in found
                continue
            length = min(how.window, len(pattern))
            best = min(distance_within(pattern[s : s + length], codes) for s in range(len(pattern) - length + 1))
            assert (i in found) == (best <= how.budget(length)), (i, best, found)
            if i in found:
                assert found[i][3] == best


def test_fragments_at_every_offset():
    """A copied fragment of one window is found wherever in the item it begins, also with edits within the budget."""
    rng, how = random.Random(3), D.Matching()
    item = letters(rng, 60)
    patterns, codes = D.Patterns([(7, item)], how), D.normalise(item)[0]
    plain = codes.tobytes().decode("utf-32-le")
    for start in range(len(codes) - how.window + 1):
        part = plain[start : start + how.window]
        if part[0] == " " or part[-1] == " ":
            continue  # the space is not part of the copy
        doc = letters(rng, 9) + " # " + part + " # " + letters(rng, 9)
        (found,) = D.find(doc, patterns)
        assert found[0] == 7 and found[3] == 0 and part in doc[found[1] : found[2]] and D.holds_any(doc, patterns)
    part = plain[41 : 41 + how.window]
    assert D.holds_any("x " + part[:30] + "k" + part[31:60] + "kk" + part[61:] + " y", patterns)
    assert not D.holds_any(plain[41:81] + " " + letters(rng, 20), patterns)


def test_slices_and_repetitive_texts(monkeypatch):
    """Scanning in small slices finds the same; a long text of one letter needs no more than a slice at a time."""
    rng = random.Random(5)
    items = [(i, letters(rng, 25)) for i in range(5)] + [(8, "a" * 200), (9, "ab" * 60)]
    patterns = D.Patterns(items, D.Matching())
    texts = [edited(rng, items[i % 7][1], i) + " " + letters(rng, 20) + items[(i + 3) % 7][1] for i in range(8)] + ["a" * 3000, "ab" * 1500, ""]
    whole = [D.find(t, patterns) for t in texts]
    assert whole[-3] and whole[-2]
    monkeypatch.setattr(D, "SLICE", 300)
    assert [D.find(t, patterns) for t in texts] == whole
    monkeypatch.undo()
    held, hits = [], D.Patterns.hits
    monkeypatch.setattr(D.Patterns, "hits", lambda self, at, slot: held.append(self.count[slot].sum()) or hits(self, at, slot))
    (found,) = D.find("a" * 60_000, patterns)
    assert found[:1] + found[3:] == (8, 0, 121) and len(held) > 1 and max(held) <= D.SLICE + 200


def test_alignment_against_full_table():
    rng, cases = random.Random(9), {}
    for _ in range(300):
        m, pad = rng.randrange(10, 30), rng.randrange(4, 9)
        p = [rng.randrange(3) for _ in range(m)]
        x = [9 if rng.random() < 0.06 else c for c in p if rng.random() > 0.05]
        t = [8] * pad + x + [8] * (2 * pad + m - len(x) - pad + 4)
        cases.setdefault((m, len(t)), []).append((p, t))
    for same in cases.values():
        got = D.align(np.array([p for p, _ in same]), np.array([t for _, t in same]))
        for (p, t), edits, start, end in zip(same, *got, strict=True):
            want = distance_within(p, t)
            assert edits == want or want > 3
            if want <= 3:
                assert distance_within(p, t[start:end]) == want


def test_whole_table(spark):
    """All documents with an exact passage are found, with the place, and no others on these tables."""
    docs, bench = (spark.read.parquet(f"{DATA}/sf0.01/{t}.parquet") for t in ("documents", "benchmark"))
    plain = lambda t: D.normalise(t or "")[0].tobytes().decode("utf-32-le")
    texts, items = dict(docs.select("doc_id", "text").collect()), {r.item_id: plain(r.text) for r in bench.collect()}
    want = {(d, i) for d, t in texts.items() for i, b in items.items() if len(b) >= 30 and b in plain(t)}
    got = D.contamination(docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got if r.edits == 0} >= want and want
    for r in got:
        if (r.doc_id, r.item_id) in want:
            assert items[r.item_id] in plain(texts[r.doc_id][r.start : r.end])
    small = D.contamination(docs, bench, D.Matching(block=500))
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, got))
    assert {r.doc_id for r in D.clean(docs, bench).collect()} == set(texts) - {r.doc_id for r in got}


def test_odd_rows(spark):
    item = "The quick brown fox, jumps over the lazy dog and runs far away from here."
    docs = [(1, None), (2, ""), (3, item), (3, item), (None, "x " + item.upper()), (4, "\U0001F600é\n" + "lorem ipsum dolor " * 40_000 + item.replace(",", "\n-")), (5, item[:40])]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"item_id": F.lit(9), "start": F.lit("s"), "a.b": F.lit(0)})
    bench = spark.createDataFrame([(1, item), (1, item), (2, None), (3, ""), (4, "too short"), (None, "another one of enough characters, not there")], "item_id long, text string")
    got = sorted((r.doc_id or 0, r.item_id, r.edits) for r in D.contamination(frame, bench).collect())
    assert got == [(0, 1, 0)] * 2 + [(3, 1, 0)] * 4 + [(4, 1, 0)] * 2
    assert sorted(r.doc_id for r in D.clean(frame, bench).collect()) == [1, 2, 5] and D.clean(frame, bench).columns == frame.columns
    assert D.contamination(frame, bench.limit(0)).count() == 0 == D.contamination(frame.limit(0), bench).count()
    long = next(r for r in D.contamination(frame, bench).collect() if r.doc_id == 4)
    assert docs[5][1][long.start : long.end].startswith("The quick") and docs[5][1][long.start : long.end].endswith("here")
