"""The operators against brute force, and on the cases that any of them has to stand."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from meterline.llm import katz, language, mixing, neardup, pii, quality, segment_search, sentence_pieces, tree_search, urls
from meterline.llm.queries import ORACLES, QUERIES, URL_RULES, VOCABULARY
from tests.conftest import SMALL, plan_of, rows
from tests.oracle import database, differences

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key1 string, node int"


def prose(seed: int, n: int, syllables="ka lo mi tu re sa ve no".split()) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and columns with names in use."""
    same = (1, prose(1, 60) + ".", "aa", "s0", 9, "x", 1)
    rows = [
        same, same, (2, prose(1, 60) + ".", "aa", "s0", 9, None, None), (3, None, "bb", "s1", None, None, 2),
        (4, "", "bb", None, 0, None, 2), (5, prose(2, 20_000), None, "s1", 9, None, 2), (6, "!!! ???", "bb", "s1", 7, None, 2),
        (7, "!!! ???", "bb", "s1", 7, None, 2), (None, prose(3, 30), None, None, None, None, None), (8, "a" * 5000, "bb", "s0", 1, None, 1),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_language_of_mixtures(spark):
    other = "zi px qu wo".split()
    train = [(("a", prose(i, 50)) if i % 2 else ("b", prose(i, 50, other))) for i in range(20)]
    model = language.fit(spark.createDataFrame(train, "lang string, text string"))
    rows = [(1, prose(91, 40)), (2, prose(92, 40, other)), (3, prose(93, 60) + " " + prose(94, 20, other)), (4, None), (5, "12 !")]
    got = {r.doc_id: r for r in language.predict(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert [got[i].lang_pred for i in range(1, 6)] == ["a", "b", "a", "und", "und"]
    assert got[1].langs == ["a"] and got[3].langs == ["a", "b"] and abs(got[3].score - 0.75) < 0.1 and got[4].score == 0


def test_language_on_odd_rows(odd, empty):
    model = language.fit(odd)
    assert language.predict(odd, model).count() == odd.count()
    unknown = language.predict(odd, language.fit(empty)).collect()
    assert {r.lang_pred for r in unknown} == {"und"} and language.predict(empty, model).isEmpty()


def brute_jaccard(x: Counter, y: Counter) -> float:
    return sum(1 / sum(max(x[e] / x[d], y[e] / y[d]) for e in x.keys() | y.keys()) for d in x.keys() & y.keys())


def test_probability_jaccard():
    rng = np.random.default_rng(3)
    for _ in range(20):
        x, y = (Counter(rng.integers(1, 12, 15).tolist()) for _ in range(2))
        as_arrays = [(np.array(sorted(c), np.uint64), np.array([c[k] for k in sorted(c)])) for c in (x, y)]
        assert abs(neardup.probability_jaccard(*as_arrays) - brute_jaccard(x, y)) < 1e-12


def test_near_duplicate_classes(spark):
    rng, rows, texts = random.Random(5), [], []
    for group in range(12):
        base = prose(100 + group, 120).split()
        for _ in range(rng.randint(1, 14)):
            new = list(base)
            for _ in range(rng.randint(0, 7)):
                new[rng.randrange(len(new))] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(new))
    sets = [Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) for w in map(str.split, texts)]
    parent = list(range(len(texts)))

    def top(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(texts)):
        for b in range(a):
            if brute_jaccard(sets[a], sets[b]) >= 0.8:
                lo, hi = sorted((top(a), top(b)))
                parent[hi] = lo
    rows = list(enumerate(texts))
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.class_id for r in got} == {i: top(i) for i in range(len(texts))}


def test_near_duplicates_on_odd_rows(odd, empty):
    got = sorted(neardup.near_duplicates(odd).collect(), key=repr)
    want = [(1, 1), (1, 1), (2, 1), (3, 3), (4, 4), (5, 5), (6, 6), (7, 6), (8, 8), (None, None)]
    assert [tuple(r) for r in got] == sorted(want, key=lambda r: f"Row(doc_id={r[0]}, class_id={r[1]})")
    assert neardup.near_duplicates(empty).isEmpty()


def test_pseudonyms_keep_formats_and_links(spark):
    text = "card 4111 1111 1111 1111, again 4111111111111111; +1 (202) 555-0147, 1999-12-31, 10.0.0.1, ann.b7@mail.org, 123-45-6789, 4111111111111112"
    out = spark.range(1).select(pii.pseudonymised(F.lit(text), "k")).first()[0]
    m = re.fullmatch(r"card (\d{4} \d{4} \d{4} \d{4}), again (\d{16}); \+1 \(([2-9]\d\d)\) ([2-9]\d\d)-\d{4}, (\d{4}-\d\d-\d\d), (\d+)\.\d+\.\d+\.\d+, ([a-z]{3}\.[a-z]\d)@mail.org, (\d{3}-\d\d-\d{4}), 4111111111111112", out)
    assert m and m[1].replace(" ", "") == m[2] != "4" + "1" * 15
    digits = [int(c) for c in m[2]][::-1]
    assert sum(digits[::2] + [sum(divmod(2 * d, 10)) for d in digits[1::2]]) % 10 == 0


def test_phones_off_the_number_plan(spark):
    phones = [f"+1 ({a:03d}) {e:03d}-{n:04d}" for a in (0, 17, 132, 199, 200, 911) for e in (0, 55, 199, 200, 555) for n in (0, 7713)]
    rows = spark.createDataFrame([(p,) for p in phones], "p string").select("p", pii.pseudonymised(F.concat(F.lit("call "), "p"), "k").alias("out"))
    got = {r.p: r.out for r in rows.collect()}
    assert len(set(got.values())) == len(phones) and all(got[p] != f"call {p}" for p in phones)
    planned = lambda p: p[-13] >= "2" and p[-8] >= "2"
    assert all(re.fullmatch(r"call \+1 \(\d{3}\) \d{3}-\d{4}", x) and planned(x) == planned(p) for p, x in got.items())


def test_values_within_runs_of_digits(spark):
    card, other, solid = "4111 1111 1111 1111", "5500-0000-0000-0004", "4111111111111111"
    texts = [
        solid, f"room 12 {card}", "no 7 4111-1111-1111-1111", f"{card} 123 45", f"12345 6780 {card} 5", f"{card} {other}", f"{card} 31/12/1999",
        f"{card} 10.0.0.1", "room 1234 202-555-0147", "6 2024-01-02 12345", "4111 1111 1111 1112", "0" * 30, "9" * 21 + " 7 " + ("8" * 21 + " ") * 3000 + solid, "9" * 30_000 + " " + solid,
    ]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    out = rows.select("i", pii.pseudonymised(F.col("t"), "k").alias("t"), F.filter(pii.found(F.col("t")), lambda m: pii.kind_of(m).isNotNull()).alias("found"))
    got = {r.i: r for r in out.collect()}
    new, date = got[0].t, got[6].t[-10:]
    spaced = " ".join(new[i : i + 4] for i in range(0, 16, 4))
    assert new != solid and [got[i].t for i in (1, 2, 3, 4)] == [f"room 12 {spaced}", f"no 7 {spaced.replace(' ', '-')}", f"{spaced} 123 45", f"12345 6780 {spaced} 5"]
    assert got[5].t.startswith(spaced + " ") and got[5].t[20:] != other and got[5].found == [card, other]
    assert got[6].t[:20] == got[7].t[:20] == spaced + " " and date != "31/12/1999" and got[6].found == [card, "31/12/1999"] and got[7].found == [card, "10.0.0.1"]
    assert re.fullmatch(r"room 1234 \d{3}-\d{3}-\d{4}", got[8].t) and got[8].t != texts[8] and re.fullmatch(r"6 \d{4}-\d\d-\d\d 12345", got[9].t) and got[9].t != texts[9]
    assert [got[i].t for i in (10, 11)] == texts[10:12] and all(r.t.endswith(new) for r in (got[12], got[13]))


def test_dates_with_the_day_first(spark):
    n = pii.LATE_DAYS[0] * pii.LATE_DAYS[1]
    days = spark.range(n).select(pii._late_day(F.col("id").cast("int")).alias("day"))
    written = days.select("day", F.date_format("day", "dd/MM/yyyy").alias("old")).select("day", "old", pii.pseudonymised(F.col("old"), "k").alias("new"))
    ends = written.agg(F.min("day"), F.max("day"), F.count_distinct("day"), F.count_distinct("new"), F.min(F.dayofmonth("day"))).first()
    assert [str(x) for x in ends] == ["1900-01-13", pii.LAST_LATE_DAY, str(n), str(n), "13"]
    assert written.where(F.try_to_timestamp("new", F.lit("MM/dd/yyyy")).isNotNull() | ~F.col("new").rlike(pii.DAY_FIRST)).isEmpty()
    kept = written.join(written.select(F.col("old").alias("new")), "new", "left_semi").count()
    same = spark.range(1).select(*(pii.pseudonymised(F.lit(t), "k") for t in ("31/02/1999", "12/31/1999", "le 31/12/1999."))).first()
    assert kept == n and same[0] == "31/02/1999" and same[1][:2] <= "12" and re.fullmatch(r"le \d\d/\d\d/\d{4}\.", same[2]) and same[2] != "le 31/12/1999."


def test_feistel_is_a_permutation(spark):
    pairs = spark.range(35).select((F.col("id") % 7).alias("l"), F.floor(F.col("id") / 7).alias("r"))
    args = (F.lit(7), F.lit(5), F.lit("t"), "key")
    there = pairs.select("l", "r", pii.feistel(F.col("l"), F.col("r"), *args).alias("x"))
    back = there.select("l", "r", "x", pii.feistel(F.col("x.l"), F.col("x.r"), *args, back=True).alias("y")).collect()
    assert len({tuple(r.x) for r in back}) == 35 and all(tuple(r.y) == (r.l, r.r) for r in back)


def test_pseudonyms_on_odd_rows(odd, empty):
    assert pii.pseudonymise(odd, "k").exceptAll(odd.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.char_length("text")).otherwise(F.col("n_chars")))).where("text IS NOT NULL").isEmpty()
    assert pii.pseudonymise(odd, "k").columns == odd.columns and pii.pseudonymise(empty, "k").isEmpty()


def test_raking_meets_targets(spark):
    cells = spark.createDataFrame([("a", "x", "p", 10), ("a", "y", "q", 30), ("b", "x", "q", 40), ("b", "y", "p", 20)], "source string, lang string, topic string, tokens long")
    share = lambda name, **parts: spark.createDataFrame(list(parts.items()), f"{name} string, share double")
    targets = {"source": share("source", a=0.5, b=0.5), "lang": share("lang", x=0.6, y=0.4), "topic": share("topic", p=0.3, q=0.7)}
    got = mixing.rake(cells, targets, rounds=60)
    for margin, target in targets.items():
        want = {r[0]: r[1] for r in target.collect()}
        have = {r[0]: r[1] for r in got.groupBy(margin).agg(F.sum("raked")).collect()}
        assert all(math.isclose(have[k], want[k], abs_tol=1e-4) for k in want)
    c = mixing.calibrated(got, 0.5)
    assert abs(sum(min(1, c * r.raked / r.tokens) * r.tokens for r in got.collect()) - 50) < 1e-6


def test_mixing_on_odd_rows(odd, empty):
    got = mixing.mixed(odd)
    assert got.count() == odd.count() and got.where("tokens = 0 AND kept").isEmpty()
    assert mixing.sampled(odd).columns == odd.columns and mixing.mixed(empty).isEmpty()


def test_pieces_are_the_best_path_and_decode(spark, odd, empty):
    v = sentence_pieces.load(VOCABULARY)
    texts = {1: "The quick  brown fox\njumps. 中文 é\U0001f600", 2: " x ", 3: prose(7, 40), 4: "\n\n", 5: ""}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    coded = sentence_pieces.encode(docs, v)
    assert {r.doc_id: r.text for r in sentence_pieces.decode(coded, v).collect()} == texts
    known = {p: s for p, _, s in v.pieces}
    score = {i: s for _, i, s in v.pieces}
    for r in coded.where("doc_id = 3").collect():
        z, best = "▁" + texts[3].replace(" ", "▁"), [0.0]
        for j in range(1, len(z) + 1):
            best.append(max(best[a] + known.get(z[a:j], v.unknown_score if j - a == 1 else -math.inf) for a in range(max(0, j - v.longest), j)))
        assert math.isclose(best[-1], sum(score[i] for i in r.ids)) and r.n_pieces == len(r.ids)
    back = sentence_pieces.decode(sentence_pieces.encode(odd, v), v)
    assert back.exceptAll(odd.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))).isEmpty() and back.count() == odd.count()
    assert sentence_pieces.encode(empty, v).isEmpty()


def test_pieces_of_long_words_are_the_best_path(spark):
    v = sentence_pieces.load(VOCABULARY)
    rng = random.Random(11)
    texts = [prose(20 + i, 150, "tion ing the er com pre und str 中 文 é".split()).replace(" ", "") for i in range(4)]
    texts += ["".join(rng.choices("abcdefghijklmnopqrstuvwxyzABC0123456789+/", k=900)), "http://x.org/" + "query=word&" * 60, "=" * 700, "a " + "b" * 300 + " c"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    known = {p: s for p, _, s in v.pieces}
    score = {i: s for _, i, s in v.pieces}
    coded = sentence_pieces.encode(docs, v)
    for r in coded.collect():
        z, best = "▁" + texts[r.doc_id].replace(" ", "▁"), [0.0]
        for j in range(1, len(z) + 1):
            best.append(max(best[a] + known.get(z[a:j], v.unknown_score if j - a == 1 else -math.inf) for a in range(max(0, j - v.longest), j)))
        unknown = sum(v.unknown_score for c in z if c not in known)
        assert math.isclose(best[-1], unknown + sum(score.get(i, 0.0) for i in r.ids if i not in v.bytes)), r.doc_id
    assert {r.doc_id: r.text for r in sentence_pieces.decode(coded, v).collect()} == dict(enumerate(texts))
    # words short enough for the relational lattice have the same path by the fold
    table = {p: (i, float(s)) for p, i, s in v.pieces}
    short = [(w,) for t in texts for w in {"▁" + t[k : k + 40] for k in range(0, 120, 7)} if "\n" not in w]
    solved = sentence_pieces.solve(spark.createDataFrame(short, "word string").distinct(), v).collect()
    assert solved and all(r.ids == sentence_pieces.best_path(r.word, v, table) for r in solved)


def test_pieces_with_ids_of_any_type(spark):
    v = sentence_pieces.load(VOCABULARY)
    docs = spark.createDataFrame([(i, prose(i, 40)) for i in range(6)] + [(None, "a b"), (7, None)], "doc_id int, text string")
    for kind in ("smallint", "decimal(10,2)", "string", "date"):
        own = docs.withColumn("doc_id", F.expr("date_add(date'2020-01-01', doc_id)") if kind == "date" else F.col("doc_id").cast(kind))
        back = sentence_pieces.decode(sentence_pieces.encode(own, v), v)
        assert back.schema["doc_id"].dataType == own.schema["doc_id"].dataType
        assert rows(back) == rows(own.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))), kind


def test_slices_of_a_chunk_give_the_same_pieces(monkeypatch):
    batch = pa.RecordBatch.from_pydict(
        {
            "ids": [[1, 2, 3, 4]], "sizes": pa.array([[3, 0, 1, 2]], pa.list_(pa.int32())), "reply": ["7,8 9"], "long": ["5 5 5"],
            "stream": [zlib.compress(np.array([0, 1, 2, 1, 0, 0], np.uint32).view(np.uint16).reshape(-1, 2).T.tobytes())],
        }
    )
    want = [(1, [7, 8, 9, 5, 5, 5], 6), (2, [], 0), (3, [8, 9], 2), (4, [7, 7], 2)]
    for size in (1, 3, 100):
        monkeypatch.setattr(sentence_pieces, "SLICE", size)
        out = pa.Table.from_batches(sentence_pieces._assemble(iter([batch]), pa.int64())).to_pylist()
        assert [tuple(r.values()) for r in out] == want


def test_pieces_query_decodes_every_document(spark):
    got = QUERIES["op4_sentence_pieces"](spark, SMALL)
    assert got.columns == ["doc_id", "ids", "n_pieces", "text"]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", F.replace(F.coalesce("text", F.lit("")), F.lit("▁"), F.lit(" ")).alias("text"))
    back = got.select("doc_id", "text").collect()
    assert sorted(map(tuple, back), key=repr) == sorted(map(tuple, docs.collect()), key=repr)


def test_katz_is_normalised_and_recursive(spark):
    texts = [prose(i, 30, ["ka", "lo"]) for i in range(12)]
    model = katz.fit(spark.createDataFrame([(t,) for t in texts], "text string"))
    words = sorted({w for t in texts for w in t.split()})
    # all continuations of one word: texts "w x" share the first token, so their scores differ by p(x | w) p(end | x)
    p = model.tables[2].groupBy("h").agg(F.sum("p").alias("seen")).join(model.backoff[2], "h")
    lower = model.tables[2].join(model.tables[1].select("w", "p1"), "w").groupBy("h").agg(F.sum("p1").alias("lower"))
    assert all(math.isclose(r.seen + r.weight * (1 - r.lower), 1, rel_tol=1e-9) for r in p.join(lower, "h").collect())
    assert math.isclose(model.tables[1].agg(F.sum("p1")).first()[0] + model.unknown, 1, rel_tol=1e-12) and words


def katz_by_brute_force(train: list[list[str]], order: int):
    """A function that gives the probability of a word after the words before it, by plain recursion over histories."""
    start, counts = "<s>", [Counter() for _ in range(order + 1)]
    for words in train:
        padded = [start] * (order - 1) + [*words, "</s>"]
        for at in range(order - 1, len(padded)):
            for k in range(1, order + 1):
                counts[k][tuple(padded[at - k + 1 : at + 1])] += 1
    total = sum(counts[1].values())
    factor = [katz.discounts(Counter(c.values())) for c in counts]
    less = lambda k, c: factor[k][c - 1] * c if c <= katz.RELIABLE else float(c)
    kept = sum(less(1, c) for c in counts[1].values())
    unknown = max(1 - kept / total, 0.5 / (total + 1))

    def probability(word: str, before: tuple) -> float:
        k = len(before) + 1
        if k == 1:
            return less(1, counts[1][word,]) * (1 - unknown) / kept if (word,) in counts[1] else unknown
        after = {g[-1]: c for g, c in counts[k].items() if g[:-1] == before}
        if not after:
            return probability(word, before[1:])
        whole, part = sum(after.values()), sum(less(k, c) for c in after.values())
        whole += 0.5 if whole - part < 1e-9 else 0
        if word in after:
            return less(k, after[word]) / whole
        left = 1 - sum(probability(w, before[1:]) for w in after)
        return (1 - part / whole) / left * probability(word, before[1:])

    return probability, counts[1], total


@pytest.mark.parametrize("order", [1, 2, 3])
def test_katz_scores_against_recursion(spark, order):
    train = [prose(i, 14, ["ka", "lo", "mi"]) for i in range(10)] + [""]
    texts = [train[0], prose(50, 12, ["ka", "lo", "mi"]), "ka new ka  LO", "", None, train[0]]
    probability, seen, total = katz_by_brute_force([t.split() for t in train], order)
    model = katz.fit(spark.createDataFrame([(t,) for t in train], "text string"), order)
    got = katz.score(spark.createDataFrame([(i if i else None, t) for i, t in enumerate(texts)], "row long, text string"), model)
    got = {r.row: r for r in got.collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        words, r = [*(text or "").lower().split(), "</s>"], got[i or None]
        padded = ["<s>"] * (order - 1) + words
        want = sum(math.log10(probability(w, tuple(padded[at : at + order - 1]))) for at, w in enumerate(words))
        base = sum(math.log10((seen[w,] + 0.1) / (total + 0.1 * (len(seen) + 1))) for w in words)
        assert math.isclose(r.score, want, rel_tol=1e-9) and math.isclose(r.base_score, base, rel_tol=1e-9), (i, order)
        assert r.n_tokens == len(words) and r.n_known == sum((w,) in seen for w in words)


@pytest.mark.parametrize("order", [2, 3])
def test_katz_moves_occurrences_once_per_lookup(spark, order):
    texts = spark.createDataFrame([(i, prose(i, 20)) for i in range(6)], "row long, text string")
    model, was = katz.fit(texts.select("text"), order), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with tables too large to broadcast
    try:
        plan = katz.score(texts, model)._jdf.queryExecution().executedPlan()
        plan = plan.initialPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)

    def moves(node) -> tuple[int, bool]:  # exchanges above the occurrences, and whether they are below
        found = [moves(node.children().apply(i)) for i in range(node.children().size())]
        below = node.nodeName() == "MapInPandas" or any(b for _, b in found)
        return sum(n for n, _ in found) + (node.nodeName() == "Exchange" and below), below

    # one for each history length, one for the single words, one to sum by row
    assert moves(plan)[0] == order + 1


@pytest.mark.parametrize("order", [2, 3])
def test_katz_reads_texts_once_to_fit_and_gathers_no_followers(spark, order):
    texts, read = spark.createDataFrame([(i, prose(i, 20)) for i in range(6)], "row long, text string"), spark.sparkContext.accumulator(0)

    def seen(text: str) -> str:
        read.add(1)
        return text

    model = katz.fit(texts.select(F.udf(seen)("text").alias("text")), order)
    assert read.value == 6
    # a row with all words after its history would be searched for each occurrence of the history
    plan = katz.score(texts, model)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftOuter" in plan and "collect_list" not in plan and "map_from" not in plan


def test_katz_of_a_history_with_many_followers(spark):
    train = [" ".join(f"a w{i}" for i in range(j, 400, 2)) for j in (0, 1)] + ["a w1 a w1", "w7 a"]
    texts = ["a w3 a w398", "a new a a", "w9 a", "a"]
    probability, _, _ = katz_by_brute_force([t.split() for t in train], 2)
    model = katz.fit(spark.createDataFrame([(t,) for t in train], "text string"))
    got = {r.row: r.score for r in katz.score(spark.createDataFrame(list(enumerate(texts)), "row long, text string"), model).collect()}
    for i, text in enumerate(texts):
        words = ["<s>", *text.split(), "</s>"]
        want = sum(math.log10(probability(w, (before,))) for before, w in zip(words[:-1], words[1:], strict=True))
        assert math.isclose(got[i], want, rel_tol=1e-9), i


def test_katz_on_odd_rows(odd, empty):
    rows = odd.select(F.col("doc_id").alias("row"), "text")
    got = katz.score(rows, katz.fit(odd))
    assert got.where("score > 0 OR score IS NULL").isEmpty() and got.where("row = 3").first().n_tokens == 1
    assert got.count() == odd.count() and got.where("row = 1").select("n_tokens").distinct().count() == 1
    assert {r.score for r in katz.score(rows, katz.fit(empty)).collect()} == {0.0}


def test_url_rules(spark):
    pages = [
        (1, "HTTP://WWW.Example.COM/en/1?q"), (2, "http://a.example.com/en/1"), (3, "https://x.net/es/a#b"), (4, "no scheme"), (5, None),
        (6, "http://shop.com"), (7, "http://shop.com/En"), (8, "http://x.net/de/"), (9, ""),
    ]
    got = {r.page_id: r for r in urls.judge(spark.createDataFrame(pages, "page_id long, url string"), URL_RULES).collect()}
    assert [got[i].rule for i in range(1, 10)] == ["www.example.com/en/", "example.com/en/", "net/es/", None, None, None, "com/", None, None]
    assert (got[1].host, got[1].path, got[1].verdict, got[2].verdict) == ("www.example.com", "/en/1", "allow", "block")
    assert (got[4].host, got[4].path, got[6].path) == ("", "", "") and {r.verdict for r in got.values()} <= {"allow", "block"}
    assert urls.judge(spark.createDataFrame([], "page_id long, url string"), URL_RULES).isEmpty()


def vectors(spark, n=400):
    rng = np.random.default_rng(1)
    data = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(n)]
    data += [(n + i, data[50][1]) for i in range(12)]  # copies of a query
    odd = [(900, None), (950, [1.0, None] * 4), (1000, [float("nan")] * 8), (None, [1.0] * 8), (1050, [])]
    return data, spark.createDataFrame([(a, b, 1) for a, b in data + odd], "vec_id long, embedding array<float>, v int")


def test_segment_search_is_exact(spark):
    data, df = vectors(spark)
    x = np.array([[math.floor(256 * float(np.float32(c))) for c in v] for _, v in data])
    want = []
    for q in range(0, len(data), 50):
        order = sorted((-int(x[q] @ x[i]), i) for i in range(len(data)) if i != q)[:5]
        want += [(q, k, i, -s) for k, (s, i) in enumerate(order, 1)]
    assert sorted(map(tuple, segment_search.top_products(df).collect())) == want
    assert segment_search.top_products(df.limit(0)).isEmpty()


def test_segment_search_sends_no_vectors_through_the_driver(spark):
    plan = plan_of(segment_search.top_products(vectors(spark)[1]))
    assert "CartesianProduct" in plan and "Broadcast" not in plan and "Generate" not in plan


@pytest.mark.parametrize("size", [3, 300, 2.0**30])  # products of the last pass 2^53
def test_segment_search_of_blocks_in_turn(spark, monkeypatch, size):
    monkeypatch.setattr(segment_search, "BLOCK", 16)
    monkeypatch.setattr(segment_search, "CHUNK", 2)
    monkeypatch.setattr(segment_search, "TOGETHER", 3)
    rng = np.random.default_rng(4)
    x = np.floor(rng.normal(size=(150, 8)) * size)
    x[100:] = x[:50]  # equal scores
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    want = []
    for q in range(0, 150, 10):
        scores = [(-min(sum(int(a) * int(b) for a, b in zip(x[q], v, strict=True)), (1 << 63) - 1), i) for i, v in enumerate(x) if i != q]
        want += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[:4], 1)]
    assert sorted(map(tuple, segment_search.top_products(df, 4, 10, 1.0).collect())) == want


def test_tree_search_finds_neighbours(spark):
    data, df = vectors(spark)
    x = np.array([v for _, v in data], np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    got, hits, n = tree_search.nearest(df).collect(), 0, 0
    for q in range(0, len(data), 50):
        s = x @ x[q]
        s[q] = -2
        near = [r.vec_id for r in sorted(got, key=lambda r: r.rank) if r.query_id == q]
        hits, n = hits + len(set(near) & set(np.lexsort((np.arange(len(s)), -s.round(12)))[:5].tolist())), n + 5
    assert hits / n >= 0.9 and tree_search.nearest(df.limit(0)).isEmpty()


def test_quality_tells_noise_from_prose(spark, odd, empty):
    good = [(i, ". ".join(prose(i * 7 + k, 12) for k in range(8))) for i in range(60)]
    noise = [(100 + i, "$$$ ".join(prose(i, 40).split()) + "$$$") for i in range(20)]
    docs = spark.createDataFrame(good + noise, "doc_id long, text string")
    got = {r.doc_id: r.keep for r in quality.classify(docs).collect()}
    assert sum(got[i] == (i < 100) for i in got) / len(got) >= 0.9
    assert quality.classify(odd).count() == odd.count() and quality.classify(empty).isEmpty()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, name):
    assert differences(QUERIES[name](spark, SMALL), database(SMALL), ORACLES[name]) is None


def test_pipeline_stages(spark, odd):
    docs = odd
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == odd.columns, name
        assert out.count() <= docs.count()


def near_classes(texts: list[str | None]) -> list[int]:
    """By brute force, for each text the first one of its class."""
    sets = [Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else None for w in ((t or "").lower().split() for t in texts)]
    top = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if top[a] != top[b] and sets[a] and sets[b] and brute_jaccard(sets[a], sets[b]) >= 0.8:
                lo, hi = sorted((top[a], top[b]))
                top = [lo if t == hi else t for t in top]
    return top


def drawn_by_brute_force(rows: list[tuple]) -> list[tuple]:
    """The rows (doc_id, text, lang, source) that raking and the hashed draw keep, in plain Python."""
    cells, of = Counter(), []
    for _, text, lang, source in rows:
        lines = text.count("\n") + 1 if text else 1
        topic = "empty" if not text else "table" if " | " in text else "lines" if len(text) < 60 * lines else "prose"
        n = text.count(" ") + text.count("\n") + 1 if text else 0
        of.append(((source or "-", lang or "-", topic), n))
        if n:
            cells[of[-1][0]] += n
    raked, targets = {c: float(n) for c, n in cells.items()}, []
    for at, power in enumerate((0.5, 0.7, 1.0)):
        sums = Counter()
        for c, n in cells.items():
            sums[c[at]] += n
        targets.append({k: v**power / sum(x**power for x in sums.values()) for k, v in sums.items()})
    for _ in range(20):
        for at, target in enumerate(targets):
            sums = Counter()
            for c, r in raked.items():
                sums[c[at]] += r
            raked = {c: r * target[c[at]] / sums[c[at]] for c, r in raked.items()}
    low, high, goal = 0.0, 1 / min(raked[c] / n for c, n in cells.items()), sum(cells.values()) / 2
    for _ in range(200):
        middle = (low + high) / 2
        fits = sum(min(1, middle * raked[c] / n) * n for c, n in cells.items()) < goal
        low, high = (middle, high) if fits else (low, middle)
    draw = lambda i: int(hashlib.md5(f"mix|{'' if i is None else i}".encode()).hexdigest()[:12], 16) / (1 << 48)
    return [r for r, (c, n) in zip(rows, of, strict=True) if n and draw(r[0]) < min(1, high * raked[c] / cells[c])]


def test_pipeline_run_against_brute_force(spark, tmp_path):
    """All five stages, with ids that several texts share, rows without id, copies, near copies and odd texts."""
    rng, given = random.Random(8), []
    for group in range(16):
        base = prose(300 + group, 90).split()
        for k in range(rng.randint(1, 5)):
            new = list(base)
            for _ in range(rng.choice([0, 1, 2, 30])):
                new[rng.randrange(len(new))] = prose(rng.randrange(10**6), 1) + "x"
            text = " ".join(new) + rng.choice(["", " Call +1 (212) 555-0147.", " On 1999-12-31 | x", " a@b.org\nline\nline"])
            given.append((rng.choice([None, 7, group * 10 + k]), text, "aa", f"s{group % 3}"))
    given += [given[0], given[0], (5, None, "aa", "s1"), (6, "", None, "s1"), (None, "12 34 !", "aa", None), (7, "other words", "aa", "s0")]
    spark.createDataFrame(given, "doc_id long, text string, lang string, source string").coalesce(2).write.parquet(f"{tmp_path}/documents.parquet")

    lettered = [r for r in given if r[1] and re.search(r"[^\W\d_]", r[1])]
    best = {}
    for r, c in zip(lettered, near_classes([r[1] for r in lettered]), strict=True):
        if c not in best or (r[0] is None, r[0] or 0) < (best[c][0] is None, best[c][0] or 0):
            best[c] = r
    v = sentence_pieces.load(VOCABULARY)
    coded = corpus_pipeline.run(spark, str(tmp_path))
    assert coded.columns == ["doc_id", "ids", "n_pieces"]
    got = sentence_pieces.with_text(coded, v).collect()

    # rows of a class that share the smallest id, or have none, may stand for each other, so what is left is compared with all choices
    alike = Counter((c, r[0]) for c, r in zip(near_classes([r[1] for r in lettered]), lettered, strict=True))
    clear = [r for c, r in best.items() if alike[c, r[0]] == 1]
    shape = lambda t: re.sub(r"\S+@\S+", "@", re.sub(r"[0-9]", "0", t))
    kept = drawn_by_brute_force(list(best.values()))
    want = Counter((r[0], shape(r[1])) for r in kept if r in clear)
    found = Counter((r.doc_id, shape(r.text)) for r in got)
    assert want and not want - found and len(got) == len(kept)
    table = {p: (i, float(s)) for p, i, s in v.pieces}
    for r in got:
        assert r.ids == [i for w in sentence_pieces.words(r.text) for i in sentence_pieces.best_path(w, v, table)] and r.n_pieces == len(r.ids)
    assert "212) 555-0147" not in " ".join(r.text for r in got)


def test_representatives_are_rows(spark, odd, empty):
    got = neardup.representatives(odd)
    assert got.columns == odd.columns and neardup.representatives(empty).isEmpty()
    assert sorted((r.doc_id for r in got.collect()), key=str) == [1, 3, 4, 5, 6, 8, None]
    same = odd.where("doc_id = 1").select("*", F.lit(3).alias("_row"))
    assert [r._row for r in neardup.representatives(same.union(same)).collect()] == [3]


def test_stages_keep_rows_in_place(spark, odd):
    """No stage but near-duplicates sends texts anywhere: rows are judged where they are read."""
    docs = odd.select("*", F.lit("y").alias("_cell"))
    assert "Exchange" not in plan_of(language.identified(odd, language.fit(odd)))
    got = mixing.sampled(docs, fraction=0.9)
    kept = mixing.mixed(odd, fraction=0.9).where("kept")
    assert got.columns == docs.columns and rows(got.select("doc_id")) == rows(kept.select("doc_id"))


def variants(seed: int, n: int, changes: int) -> list[tuple[int, str]]:
    """Near copies of one text, each with some words of its own."""
    rng, base = random.Random(seed), prose(seed, 150).split()
    out = []
    for k in range(n):
        new = list(base)
        for _ in range(rng.randint(0, changes)):
            new[rng.randrange(len(new))] = f"x{rng.randrange(10**6)}"
        out.append((k, " ".join(new)))
    return out


def one_bucket(spark, docs):
    """All documents as entries of one bucket, each a component of its own, with their long signatures."""
    signed = docs.selectExpr("doc_id", "text", "0L AS raw", "0L AS size").mapInPandas(
        neardup._sign, "doc_id long, key1 long, key2 long, bands array<long>, sig binary"
    )
    texts = signed.join(docs, "doc_id").selectExpr("doc_id AS node", "array(77L) AS bands", "text")
    long = texts.mapInPandas(neardup._lengthen, "node long, bands array<long>, long binary, text string")
    return docs.selectExpr("77L AS bucket", "doc_id AS node", "doc_id AS component"), long


@pytest.mark.parametrize("block", [16, 1024])
def test_links_of_a_bucket_grow_with_its_entries(spark, block):
    """A bucket of one or of many blocks: the links connect what brute force does, and doubling the group doubles them at most."""
    counts = []
    for n in (60, 120):
        data = variants(7, n, 9)
        named, long = one_bucket(spark, spark.createDataFrame(data, "doc_id long, text string"))
        got = neardup.open_links(named, long, block).collect()
        sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (t.split() for _, t in data)]
        assert all(len(x) == len(t.split()) - 4 for x, (_, t) in zip(sets, data, strict=True))  # none repeats: the usual Jaccard
        alike = {(a, b) for a in range(n) for b in range(a) if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8}
        assert {tuple(sorted((r.a, r.b), reverse=True)) for r in got} <= alike
        assert classes(n, alike) == classes(n, [(r.a, r.b) for r in got]) and 1 < len(set(classes(n, alike))) < n
        blocks = math.ceil(n / block)
        assert len(got) <= n * blocks
        counts.append(len(got) / blocks)
    assert counts[1] <= 2.2 * counts[0]


def classes(n: int, links) -> list[int]:
    top = list(range(n))
    for a, b in links:
        x, y = top[a], top[b]
        top = [min(x, y) if t in (x, y) else t for t in top]
    return top


def test_tree_search_goes_on_until_enough_is_found(spark):
    """Tight groups and single vectors whose leaves hold few: no query gets fewer than it could."""
    rng = np.random.default_rng(24)
    groups = [c + 0.001 * rng.normal(size=(80, 16)) for c in rng.normal(size=(25, 16))]
    x = np.concatenate([rng.normal(size=(12, 16)), *groups])
    df = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    tree, leaves = tree_search.grow(x / np.linalg.norm(x, axis=1)[:, None])
    sizes = np.ones(leaves, np.int64)
    assert len(tree_search.leaves_for(tree, x[0], 1, sizes, 6)) == min(6, leaves) and len(tree_search.leaves_for(tree, x[0], 2)) == 2
    got = Counter(r.query_id for r in tree_search.nearest(df, every=4).collect())
    assert set(got) == set(range(0, len(x), 4)) and set(got.values()) == {5}
