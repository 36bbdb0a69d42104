"""The divergence audit against brute force in whole numbers."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from meterline.llm import divergence
from tests.conftest import rows
from tests.llm.test_operators import empty, odd, prose  # noqa: F401

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, least, top):
    counts, held = defaultdict(Counter), defaultdict(Counter)
    for r in docs:
        lang, source = r.lang or "", r.source or ""
        terms = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", (r.text or "").translate(LOWER))
        counts[lang, source].update(terms)
        held[lang].update(set(terms))
    out = []
    for lang in {x for x, _ in counts}:
        kept = sorted(t for t, n in held[lang].items() if n >= least)
        groups = sorted(s for x, s in counts if x == lang)

        def share(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 5) // (total + 5 * len(kept)) for t in kept}

        whole = share(sum((counts[lang, s] for s in groups), Counter()))
        p = {s: share(counts[lang, s]) for s in groups}
        for s in groups:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in groups if o != s]
            terms = [(whole[t] - p[s][t], t.encode(), t) for t in kept if counts[lang, s][t] and p[s][t] > whole[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, x[2], -x[0], k) for k, x in enumerate(found, 1)]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(3)
    data = []
    for i in range(300):
        text = prose(i, rng.randint(0, 60)) + rng.choice([" Élan", " élan É", " 中文字 x", " a1b_c-D\x00e", ""])
        source = rng.choice(["s0"] * 6 + ["s1", "s2", "s3", "é", "z" * 40, None, ""])
        data.append((i % 50, text, rng.choice(["aa", "aa", "bb", None]), source, 0, "k", 1))
    data += [(1, None, "aa", "none", 0, "k", 1), (2, "!", "cc", "one", 0, "k", 1), (3, "", "cc", "two", 0, "k", 1)]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n long, value string, rank int")


@pytest.mark.parametrize("tile", [divergence.TILE, 1, 3])
def test_against_brute_force(docs, tile, monkeypatch):
    monkeypatch.setattr(divergence, "TILE", tile)
    got = rows(divergence.audit(docs, least=4, top=7).select("lang", "source", "part", "item", "value", "rank"))
    want = brute(docs.collect(), 4, 7)
    assert got == want and {"pair", "term"} == {r[2] for r in got} and ("cc", "one", "pair", "two", 0, 1) in got


def test_odd_rows(odd, empty):  # noqa: F811
    assert rows(divergence.audit(odd, least=1)) == brute(odd.collect(), 1, 50)
    assert divergence.audit(empty).isEmpty()


@pytest.mark.parametrize("side", [5, 2])
def test_joint_prices(side, monkeypatch):
    monkeypatch.setattr(divergence, "COLUMNS", 40)
    rng = np.random.default_rng(1)
    counts = rng.zipf(1.5, (700, 5)).clip(0, 10**6) * rng.integers(0, 2, (700, 5))
    totals = [int(x) for x in counts.sum(axis=0)]
    totals[1] = 10**15  # beyond what 64 bits hold once multiplied
    p = [[1 + 10**9 * (int(c) + 5) // (totals[g] + 5 * 700) for c in counts[:, g]] for g in range(5)]
    want = [[sum(abs(x - y) for x, y in zip(p[g], p[h], strict=True)) for h in range(5)] for g in range(5)]
    others = range(5) if side == 5 else range(side, 5)
    assert divergence.joint_prices(counts, totals, 700, side).tolist() == [[want[g][h] for h in others] for g in range(side)]


def test_counts_are_handed_on_when_there_are_many(monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 50)
    data = {"text": [prose(i, 40) for i in range(30)], "lang": ["a"] * 30, "source": ["s"] * 30}
    found = [r for b in divergence._counted(iter([pa.RecordBatch.from_pydict(data)])) for r in b.to_pylist()]
    n, docs = Counter(), Counter()
    for r in found:
        n[r["term"]] += r["n"]
        docs[r["term"]] += r["docs"]
    assert len(found) > len(n) and n == Counter(w for t in data["text"] for w in t.split())
    assert docs == Counter(w for t in data["text"] for w in set(t.split()))
