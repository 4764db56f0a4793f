"""The training-data operators: brute force, exact round trips, hand-made and dirty cases."""

import random
from collections import defaultdict
from datetime import datetime, timedelta, timezone

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from headwaykit.llm.history import append_keys, known_already, known_by_batches, pivot_points
from headwaykit.llm.mixing import _schedule, amounts, fair_slots, mix, segments_of
from headwaykit.llm.nearest import match_nearest
from headwaykit.llm.quantiles import error_bound, merge_summaries, packed, percentile_columns, rank_share, summarise
from headwaykit.llm.runs import collapse_runs
from headwaykit.llm.spans import Hasher, anchor_table, seed_contexts, shared_amounts, shared_spans, shared_stretches, sharing_pairs, text_classes
from headwaykit.llm.tokens import encode_corpus, encode_long, encode_run, encoder, fold, vocabulary_file
from headwaykit.llm.tokens import pieces as cut

START = datetime(2026, 3, 1, 20, 0, tzinfo=timezone.utc)


@pytest.fixture(scope="module")
def enc():
    with open(vocabulary_file(), "rb") as f:
        return encoder(f.read())


# --- percentiles


def test_shares_are_within_the_bound_and_groups_with_null_keys_stay(spark):
    rng = np.random.default_rng(1)
    rows = [("a" if i % 3 else None, float(x)) for i, x in enumerate(rng.lognormal(3, 2, 30_000))] + [("b", float("nan")), ("b", None), ("c", 5.0), ("c", 5.0)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(7)
    k = 64
    packs = packed(summarise(df, ["g"], "x", k, held=2_000), ["g"])
    got = {r.g: r for r in packs.select("g", "n", *percentile_columns(F.col("buffers"), F.col("n"), {"p10": 0.1, "p50": 0.5, "p99": 0.99})).collect()}
    assert set(got) == {"a", None, "c"} and got["c"].p50 == 5.0
    for g in ("a", None):
        values = np.sort([x for h, x in rows if h == g and x is not None])
        assert got[g].n == len(values)
        for share, name in ((0.1, "p10"), (0.5, "p50"), (0.99, "p99")):
            rank = np.searchsorted(values, got[g][name], side="right") / len(values)
            assert abs(rank - share) <= error_bound(len(values), k) * 2 + 1 / k
    shares = packs.where("g = 'a'").select(rank_share(F.col("buffers"), F.col("n"), F.lit(20.0)).alias("s")).first().s
    values = np.array([x for h, x in rows if h == "a"])
    assert abs(shares - (values <= 20).mean()) <= error_bound(len(values), k)


def test_summaries_of_days_merge(spark):
    rows = [(d, float(x)) for d in range(4) for x in range(d * 1000, d * 1000 + 1000)]
    df = spark.createDataFrame(rows, "d int, x double").withColumn("g", F.lit(1))
    parts = [summarise(df.where(F.col("d") == d), ["g"], "x", 32) for d in range(4)]
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    r = packed(merge_summaries(whole, ["g"], 32), ["g"]).select("n", *percentile_columns(F.col("buffers"), F.col("n"), {"m": 0.5})).first()
    assert r.n == 4000 and abs(r.m - 2000) <= 4000 * (error_bound(4000, 32) + 1 / 32)


def test_summaries_of_another_size_are_refused(spark):
    df = spark.range(5000).select(F.lit("g").alias("g"), F.col("id").cast("double").alias("x"))
    for k, other in ((64, 32), (32, 64)):
        with pytest.raises(Exception, match="is not of summaries of"):
            merge_summaries(summarise(df, ["g"], "x", k), ["g"], other).collect()
    whole = merge_summaries(summarise(df.drop("g"), [], "x", 64), [], 64)
    assert packed(whole, []).first().n == 5000


def test_percentiles_of_nothing(spark):
    df = spark.createDataFrame([], "g string, x double, level int, vals int")
    assert summarise(df, ["g"], "x").count() == 0


# --- runs

EVENTS = "stage_row long, event_key string, ingestion_timestamp timestamp, vehicle_id string, trip_id string, vehicle_timestamp timestamp, current_status int, current_stop_sequence int"


def event(n, second, status, sequence, vehicle="v", trip="t"):
    at = START + timedelta(seconds=second)
    return (n, f"{n:064x}", at, vehicle, trip, at, status, sequence)


def runs_of(rows, gap=600, tolerance=0):
    """Plain statement of the rule over one entity's sorted (second, status, sequence)."""
    out, prev = [], None
    alike = lambda a, b: a is b if a is None or b is None else abs(a - b) <= tolerance
    for t, s, q in rows:
        new = prev is None or t - prev[0] > gap
        s = s if s is not None or new else prev[1]
        q = q if q is not None or new else prev[2]
        if not new and s == out[-1][3] and alike(out[-1][4], q):
            out[-1][1], out[-1][2] = t, out[-1][2] + 1
        else:
            out.append([t, t, 1, s, q])
        prev = (t, s, q)
    return out


def test_runs_against_brute_force_over_days(spark):
    random.seed(4)
    rows, n, want = [], 0, []
    for v in range(6):
        t, own = 0, []
        for _ in range(400):
            t += random.choice((10, 60, 600, 601, 3000))
            n += 1
            s, q = random.choice((0, 1, 1, None)), random.choice((1, 1, 2, None))
            own.append((t, s, q))
            rows.append(event(n, t, s, q, f"v{v}", "t"))
        want += [(f"v{v}", *r) for r in runs_of(own)]
    again = [(*r[:1], r[1].upper() + " ", r[2] + timedelta(seconds=9), *r[3:]) for r in rows[::5]]
    again = [(r[0] + 100_000, *r[1:]) for r in again]
    random.shuffle(rows)
    zero = int(START.timestamp()) * 1_000_000
    got = [(r.vehicle_id, (r.t0 - zero) // 1_000_000, (r.t1 - zero) // 1_000_000, r.n, r.status, r.sequence) for r in collapse_runs(spark.createDataFrame(rows + again, EVENTS)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_runs_within_a_tolerance_and_of_dirty_tables(spark):
    rows = [event(1, 0, 1, 5), event(2, 10, 1, 6), event(3, 20, 1, 7)]
    df = spark.createDataFrame(rows, EVENTS)
    assert sorted(r.n for r in collapse_runs(df, sequence_tolerance=1).collect()) == [1, 2]
    bad = spark.createDataFrame([(1, None, None, None, "t", START, 1, 1), (2, None, None, "v", None, START, 1, 1), (3, None, None, "v", "t", None, 1, 1)], EVENTS)
    assert collapse_runs(bad).count() == 0 and collapse_runs(spark.createDataFrame([], EVENTS)).count() == 0
    assert collapse_runs(df.withColumns({"t": F.lit(1), "n": F.lit(2), "day": F.lit(3), "part": F.lit(4)})).count() == 3


@pytest.mark.parametrize("tolerance", [0, 1, 2])
def test_runs_do_not_depend_on_the_cut(spark, tolerance):
    rng = random.Random(tolerance)
    rows, want, n = [], [], 0
    for v in range(5):
        t, q, own = 0, 5, []
        for _ in range(150):
            t += rng.choice((1, 5, 10, 10, 40)) + (700 if rng.random() < 0.02 else 0)
            q += rng.choice((0, 0, 0, 1, 1, -1)) + (5 if rng.random() < 0.02 else 0)
            n += 1
            seen = (t, None if rng.random() < 0.05 else 1 + (rng.random() < 0.05), None if rng.random() < 0.1 else q)
            own.append(seen)
            rows.append(event(n, *seen, f"v{v}"))
        want += [(f"v{v}", *r) for r in runs_of(own, tolerance=tolerance)]
    zero = int(START.timestamp()) * 1_000_000
    df = spark.createDataFrame(rows, EVENTS)
    for chunk in (7, 30, 600, 21_600):
        got = [(r.vehicle_id, (r.t0 - zero) // 1_000_000, (r.t1 - zero) // 1_000_000, r.n, r.status, r.sequence) for r in collapse_runs(df, sequence_tolerance=tolerance, chunk_s=chunk).collect()]
        assert sorted(got, key=str) == sorted(want, key=str), chunk


# --- nearest


def test_nearest_against_brute_force(spark):
    random.seed(2)
    left = [(i, random.choice("ab"), random.randrange(0, 3 * 86_400) * 1_000_000) for i in range(500)] + [(900, None, 5), (901, "a", None), (902, "z", 5)]
    right = [(random.choice("ab"), random.randrange(0, 3 * 86_400) * 1_000_000 + 1, k) for k in range(300)]
    right += right[:40] + [(None, 3, 0), ("a", None, 0)]
    lf = spark.createDataFrame(left, "id long, e string, t long")
    rf = spark.createDataFrame(right, "e string, at long, k long")
    got = {r.id: (r.distance_us, r.k) for r in match_nearest(lf, rf, "e", "t", "at", ["k"], 600).collect()}
    want = {}
    for i, e, t in left:
        near = [(abs(a - t), k) for f, a, k in right if e is not None and f == e and a is not None and t is not None]
        if near and min(near)[0] <= 600_000_000:
            want[i] = min(near)
    assert got == want


def test_nearest_at_the_tolerance_and_midway(spark):
    lf = spark.createDataFrame([(1, "a", 600_000_000), (2, "a", -600_000_001), (3, "b", 50)], "id long, e string, t long")
    rf = spark.createDataFrame([("a", 0, 1), ("b", 0, 1), ("b", 100, 2)], "e string, at long, k long")
    assert {r.id: r.k for r in match_nearest(lf, rf, "e", "t", "at", ["k"], 600).collect()} == {1: 1, 3: 2}
    assert match_nearest(lf.where("false"), rf, "e", "t", "at", ["k"], 600).count() == 0
    assert match_nearest(lf, rf.where("false"), "e", "t", "at", ["k"], 600).count() == 0


# --- history

STAGE = "stage_row long, event_key string, ingestion_timestamp timestamp, vehicle_id string, trip_id string, vehicle_timestamp timestamp, latitude double, longitude double"


def stage(n=300, seed=3):
    random.seed(seed)
    rows = []
    for i in range(n):
        at = START + timedelta(seconds=random.randrange(0, 400))
        key = f"{random.randrange(200):064x}"
        key = random.choice((key, key.upper(), f"sha256:{key}", None))
        null = lambda x: None if random.random() < 0.05 else x
        rows.append((i, key, START + timedelta(seconds=random.randrange(0, 50) * 60), null(random.choice("ab")), null(random.choice("xy")), null(at), null(42 + random.randrange(0, 8) * 3e-4), null(-71.0)))
    return rows


def repeats(rows, registry):
    from headwaykit.functions.geo import haversine

    norm = lambda k: None if k is None else k.lower().replace("sha256:", "")
    seen, before, out = {norm(k) for k in registry}, [], set()
    for r in sorted(rows, key=lambda r: (r[2], r[0])):
        k = norm(r[1])
        near = None not in r[3:] and any(None not in b[3:] and b[3:5] == r[3:5] and abs((b[5] - r[5]).total_seconds()) <= 2 and haversine(b[6], b[7], r[6], r[7]) <= 50 for b in before)
        if k is not None and k in seen or near:
            out.add(r[0])
        seen.add(k)
        before.append(r)
    return out


def test_history_against_brute_force_and_batch_by_batch(spark, tmp_path):
    rows, registry = stage(), [f"{k:064x}" for k in range(20)]
    df, reg = spark.createDataFrame(rows, STAGE), spark.createDataFrame([(k,) for k in registry], "event_key string")
    want = repeats(rows, registry)
    assert {r.stage_row for r in known_already(df, reg).collect()} == want
    assert len(want) > 50
    rows.sort(key=lambda r: (r[2], r[0]))
    cuts = [0, 100, 180, 300]
    while any(rows[c][2] == rows[c - 1][2] for c in cuts[1:-1]):
        cuts = [c if c in (0, 300) or rows[c][2] != rows[c - 1][2] else c + 1 for c in cuts]
    got = known_by_batches([spark.createDataFrame(rows[a:b], STAGE) for a, b in zip(cuts, cuts[1:])], reg, str(tmp_path / "points"), str(tmp_path / "keys"))
    assert {r.stage_row for r in got.collect()} == want


def test_stored_keys_of_any_spelling_are_met_again(spark, tmp_path):
    path = str(tmp_path / "keys")
    keys = ["legacy-key-1", "ab" * 32, "  Plain Text ", "x", "", None, "deadbeef"]
    row = lambda n, k: (n, k, START + timedelta(minutes=n), None, None, None, None, None)
    append_keys(spark.createDataFrame([row(i, k) for i, k in enumerate(keys)], STAGE), path)
    again = ["LEGACY-KEY-1 ", "sha256:" + "AB" * 32, "plain text", "X", " ", None, "DeadBeef", "new"]
    batch = spark.createDataFrame([row(100 + i, k) for i, k in enumerate(again)], STAGE)
    assert {r.stage_row for r in known_already(batch, spark.read.parquet(path)).collect()} == {100, 101, 102, 103, 104, 106}


def test_history_of_copies_and_empty_tables(spark):
    one = stage(1)[0]
    copies = [(i, None, START, "a", "x", START, 42.0, -71.0) for i in range(50)]
    got = known_already(spark.createDataFrame(copies, STAGE).withColumns({"t": F.lit(1), "first": F.lit(2), "d0": F.lit(3)}))
    assert got.count() == 49
    empty = spark.createDataFrame([], STAGE)
    assert known_already(empty).count() == 0 and pivot_points(empty, 2, 50).count() == 0
    assert known_already(spark.createDataFrame([one], STAGE), spark.createDataFrame([], "event_key string")).count() == 0


def test_history_of_records_given_twice(spark):
    rows, registry = stage(), spark.createDataFrame([(f"{k:064x}",) for k in range(20)], "event_key string")
    once = {r.stage_row for r in known_already(spark.createDataFrame(rows, STAGE), registry).collect()}
    twice = known_already(spark.createDataFrame(rows + rows[::2], STAGE), registry).collect()
    assert len(twice) == len(once) and {r.stage_row for r in twice} == once


# --- tokens


def test_corpus_equals_the_tokenizer(spark, enc):
    random.seed(6)
    texts = [None, "", " ", "\r\n\n", "ordinary words, and <|endoftext|> too", "中" * 300, "x" * 999, "\n\n" + "9" * 500, "a'b " * 200, "́" * 300, " 　 é" * 90]
    texts += ["".join(random.choice("etaoinshrdlu") for _ in range(random.randrange(100, 900))) for _ in range(20)]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    got = {r.doc_id: list(r.ids) for r in encode_corpus(df, piece_chars=64).collect()}
    assert got == {i: enc.encode_ordinary(t or "") for i, t in enumerate(texts)}
    assert all(enc.decode(got[i]) == (t or "") for i, t in enumerate(texts))
    counts = {r.doc_id: r.ids for r in encode_corpus(df, piece_chars=64, counts=True).collect()}
    assert counts == {i: len(x) for i, x in got.items()}
    assert encode_corpus(df.where("false")).count() == 0


def test_texts_of_many_blocks(spark, enc):
    random.seed(12)
    runs = ["x" * 3000, "中" * 700, "ab cd " * 300, "9" * 2000, "\n" * 900, "mixed'run's" * 60, "-=" * 400]
    texts = ["".join(random.choice(runs) for _ in range(random.randrange(1, 7))) for _ in range(25)] + ["q" * 40_000, "word " * 5000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (3, texts[3])], "doc_id long, text string").repartition(5)
    got = [(r.doc_id, list(r.ids)) for r in encode_corpus(df, piece_chars=20).collect()]
    want = {i: enc.encode_ordinary(t) for i, t in enumerate(texts)}
    assert len(got) == len(texts) + 2 and all(ids == want[i] for i, ids in got) and sum(i == 3 for i, _ in got) == 3


def test_folding_keeps_the_ids(enc):
    pieces = lambda text, size: [(inner, encode_run(enc, p.encode()) if inner else enc.encode_ordinary(p)) for inner, p in cut(text, size)]
    for text in ("x" * 500, "a b " + "y" * 300 + " c " + "z" * 300, "plain words only", "9" * 90 + " " + "w" * 200):
        parts = pieces(text, 16)
        for k in (1, 3, 100):
            folded = [f for i in range(0, len(parts), k) for f in fold(parts[i : i + k], enc)]
            whole = fold(folded, enc)
            assert len(whole) <= 3 and [i for _, ids in whole for i in ids] == enc.encode_ordinary(text)


def test_rows_of_one_id_give_a_row_each(spark, enc):
    texts = ["some words " * 30, "x" * 400, "x" * 400, "other words " * 30, "short", "short", None]
    df = spark.createDataFrame([(n // 4, t) for n, t in enumerate(texts)] + [(None, "9" * 300)] * 2, "doc_id long, text string")
    want = sorted([(str(n // 4), enc.encode_ordinary(t or "")) for n, t in enumerate(texts)] + [("None", enc.encode_ordinary("9" * 300))] * 2)
    for size in (64, 8192):
        assert sorted((str(r.doc_id), list(r.ids)) for r in encode_corpus(df, piece_chars=size).collect()) == want


def test_tree_concatenation_on_random_texts(enc):
    random.seed(7)
    alphabet = ["a", "b", "é", "中", "1", "9", " ", "\n", "'", "s", "!", "?", "　", "Z", "_", "́", "😀", "\x1c"]
    for n in range(1500):
        own = random.sample(alphabet, random.choice((1, 2, 3, 8)))
        text = "".join(random.choice(own) * random.choice((1, 1, 2, 30)) for _ in range(random.randint(1, 30)))
        for size in (8, 32):
            assert encode_long(text, enc, size) == enc.encode_ordinary(text)


# --- mixing


def test_amounts():
    targets = {"a": (0.5, 1), "b": (0.3, 2), "c": (0.2, 4), "none": (0.1, 3)}
    got = amounts({"a": 1000, "b": 400, "c": 100}, targets)
    assert got["none"] == 0 and got["a"] == pytest.approx(1000) and got["b"] == pytest.approx(600) and got["c"] == pytest.approx(400)
    tight = amounts({"a": 1000, "b": 1000, "c": 10}, targets, total=1000)
    assert tight["c"] == 40 and tight["a"] / tight["b"] == pytest.approx(5 / 3) and sum(tight.values()) == pytest.approx(1000)
    assert amounts({}, targets) == dict.fromkeys(targets, 0.0)


def test_fair_slots_stay_within_a_block():
    blocks = {"a": 57, "b": 31, "c": 11, "d": 1, "e": 0}
    slots, total = fair_slots(blocks), 100
    assert sorted(x for s in slots.values() for x in s) == list(range(total))
    for s, n in blocks.items():
        done = np.zeros(total + 1)
        for x in slots[s]:
            done[x + 1] += 1
        assert (np.abs(np.cumsum(done) - n / total * np.arange(total + 1)) < 1).all()


@pytest.mark.parametrize("segment", [7, 40, 1000])
def test_segments_give_every_slot_once_and_stay_near_the_shares(segment):
    blocks = {"a": 570, "b": 310, "c": 110, "d": 1, "e": 0, "f": 9}
    segments = segments_of(1000, segment)
    ids = pa.RecordBatch.from_arrays([pa.array(range(segments), pa.int64())], names=["id"])
    rows = [r for part in _schedule(iter([ids]), blocks, segments) for r in part.to_pylist()]
    assert sorted(r["_slot"] for r in rows) == list(range(1000))
    for s, n in blocks.items():
        own = sorted((r["_block"], r["_slot"]) for r in rows if r["source"] == s)
        assert [b for b, _ in own] == list(range(n)) and [x for _, x in own] == sorted(x for _, x in own)
        done = np.zeros(1001)
        done[[x + 1 for _, x in own]] = 1
        off = np.abs(np.cumsum(done) - n / 1000 * np.arange(1001)).max()
        assert off < (1 if segments == 1 else 1.5 + len(blocks) / 2 * n / 1000)


def test_uses_lie_in_their_blocks_in_segments_as_in_one(spark):
    docs = [(i % 900, "ab"[i % 3 == 0], 30 + i % 40) for i in range(1000)]  # some rows twice
    df = spark.createDataFrame(docs, "doc_id long, source string, size long")
    targets = spark.createDataFrame([("a", 0.5, 2), ("b", 0.5, 2)], "source string, target_share double, max_repeats int")
    plain = mix(df, targets, "size", block=500).collect()
    cut = mix(df, targets, "size", block=500, segment=20).collect()
    assert len(plain) == len(cut) == 1000 and sorted((r.doc_id, r.uses) for r in plain) == sorted((r.doc_id, r.uses) for r in cut)
    for rows in (plain, cut):
        size = defaultdict(int)
        for r in rows:
            assert len(r.slots) == r.uses and list(r.slots) == sorted(r.slots)
            for x in r.slots:
                size[x] += r.size
        assert sorted(size) == list(range(len(size))) and all(300 < n <= 500 + 70 for x, n in sorted(size.items())[:-4])


def test_mix(spark):
    random.seed(8)
    docs = [(i, random.choice(("a", "a", "a", "b", "c", None, "other")), random.choice((0, 10, 50, None))) for i in range(3000)]
    df = spark.createDataFrame(docs, "doc_id long, source string, size long").withColumns({"slots": F.lit(1), "_order": F.lit(2)})
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.3, 2), ("c", 0.15, 3), ("gone", 0.05, 2)], "source string, target_share double, max_repeats int")
    rows = mix(df, targets, "size", block=100).collect()
    assert len(rows) == len(docs) and all(len(r.slots) == r.uses for r in rows)
    used = defaultdict(int)
    for r in rows:
        assert r.uses <= {"a": 1, "b": 2, "c": 3}.get(r.source, 0)
        used[r.source] += r.uses * r.size
    whole = sum(used.values())
    for s, share in (("a", 0.5), ("b", 0.3), ("c", 0.15)):
        assert abs(used[s] / whole - share / 0.95) < 0.01
        assert all(r.actual_share == pytest.approx(used[s] / whole) for r in rows if r.source == s)
    assert mix(df.where("false"), targets, "size").count() == 0 and all(r.uses == 0 for r in mix(df, targets.where("false"), "size").collect())


# --- spans


def brute_pairs(docs, least):
    seen, pairs = defaultdict(set), set()
    for i, t in docs:
        for j in range(len(t or "") - least + 1):
            seen[t[j : j + least]].add(i)
    for own in seen.values():
        pairs |= {(a, b) for a in own for b in own if a < b}
    return pairs, seen


def corpus():
    random.seed(9)
    word = lambda: "".join(random.choice("abcdefgh ") for _ in range(random.randrange(30, 400)))
    shared = [word() for _ in range(6)] + ["z" * 130, "xy" * 90, "é中" * 60, " \n" * 70]
    docs = [(i, "".join(random.choice((word(), random.choice(shared), random.choice(shared)[5:80])) for _ in range(random.randrange(0, 5)))) for i in range(80)]
    return docs + [(100, docs[3][1]), (101, docs[3][1]), (102, None), (103, ""), (104, "z" * 500), (105, "xy" * 300 + "q"), (106, "q" + "xy" * 200)]


@pytest.mark.parametrize("k,window", [(40, 21), (31, 30)])
def test_spans_against_brute_force(spark, k, window):
    least, docs = 60, corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"doc": F.lit(1), "hash": F.lit(2), "rep": F.lit(3)})
    classes = text_classes(df, "doc_id", "text", least)
    spans = shared_spans(seed_contexts(df, classes, k=k, window=window), least=least, k=k, window=window).cache()
    pairs, seen = brute_pairs(docs, least)
    got = [(r.doc_a, r.doc_b) for r in sharing_pairs(spans, classes).collect()]
    assert len(got) == len(set(got)) and set(got) == pairs
    text = dict(docs)
    for r in spans.collect():
        a, b = text[r.doc_a], text[r.doc_b]
        assert a[r.start_a : r.start_a + r.length] == b[r.start_b : r.start_b + r.length] and r.length >= least
        end_a, end_b = r.start_a + r.length, r.start_b + r.length
        assert min(r.start_a, r.start_b) == 0 or a[r.start_a - 1] != b[r.start_b - 1]
        assert end_a == len(a) or end_b == len(b) or a[end_a] != b[end_b]


@pytest.mark.parametrize("k,window", [(40, 21), (31, 30)])
def test_shared_amounts_against_brute_force(spark, k, window):
    least = 60
    docs = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    classes = text_classes(df, "doc_id", "text", least)
    contexts = seed_contexts(df, classes, k=k, window=window)
    got = {r.doc_id: r.shared_chars for r in shared_amounts(df, shared_stretches(contexts, k, window), classes).collect()}
    _, seen = brute_pairs(docs, least)
    for i, t in docs:
        covered = np.zeros(len(t or ""), dtype=bool)
        for j in range(len(t or "") - least + 1):
            if len(seen[t[j : j + least]]) > 1:
                covered[j : j + least] = True
        assert got[i] == covered.sum(), i


def test_one_passage_in_ten_thousand_documents(spark):
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage = word(400)
    docs = [(i, word(rng.randrange(0, 90)) + passage + word(rng.randrange(0, 90))) for i in range(10_000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(8)
    classes = text_classes(df, "doc_id", "text", 240)
    contexts = seed_contexts(df, classes)
    assert contexts.count() < 40_000  # some ten anchors each without chains: a chain, and what random surroundings have in common
    rows = shared_amounts(df, shared_stretches(contexts), classes).collect()
    assert len(rows) == 10_000 and all(400 <= r.shared_chars <= 430 for r in rows)


def test_gram_hashes_do_not_depend_on_their_place():
    hasher = Hasher(20, 5000)
    text = "".join(random.Random(1).choice("abcdef") for _ in range(300))
    a = hasher(np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32))
    b = hasher(np.frombuffer(("zzz" * 700 + text).encode("utf-32-le"), dtype=np.uint32))
    assert (a == b[2100:]).all() and len(set(a.tolist())) == len({text[i : i + 20] for i in range(281)})


def plain_anchors(text, hasher, k, window):
    """Leftmost least gram of each window, one by one; then series as sets of (hash, first place, run)."""
    if len(text) < k + window - 1:
        return set()
    grams = hasher(np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)).tolist()
    picked = sorted({min(range(a, a + window), key=lambda i: (grams[i], i)) for a in range(len(grams) - window + 1)})
    out, by = set(), defaultdict(list)
    for p in picked:
        by[grams[p]].append(p)
    for h, places in by.items():
        begin = prev = places[0]
        for p in [*places[1:], None]:
            if p is None or p - prev > window:
                out.add((h, begin, prev - begin))
                begin = p
            prev = p
    return out


@pytest.mark.parametrize("block", [1 << 20, 256])
def test_anchors_of_many_texts_equal_those_of_each(block):
    random.seed(11)
    word = lambda: "".join(random.choice("ab c") for _ in range(random.randrange(0, 120)))
    texts = ["".join(random.choice((word(), "x" * 70, "xyz" * 30)) for _ in range(random.randrange(0, 8))) for _ in range(60)] + ["", "a" * 29, "q" * 30, "ab" * 500]
    hasher = Hasher(20, 40_000)
    number, hashes, place, run, _ = anchor_table(texts, hasher, 20, 11, block)
    got = defaultdict(set)
    for t, h, p, r in zip(number.tolist(), hashes.tolist(), place.tolist(), run.tolist()):
        got[t].add((h, p, r))
    for i, text in enumerate(texts):
        assert got[i] == plain_anchors(text, hasher, 20, 11)


def test_spans_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    classes = text_classes(df, "doc_id", "text", 240)
    contexts = seed_contexts(df, classes)
    spans = shared_spans(contexts)
    assert spans.count() == 0 and sharing_pairs(spans, classes).count() == 0 and shared_stretches(contexts).count() == 0
