"""Long passages that occur word for word in more than one document, by seed and extend.

Anchors: of every `window` consecutive k-grams the one of least hash (winnowing), with k + window - 1
at most the least length, so any two occurrences of a passage of that length share an anchor at the
same place in it. Anchors whose hash occurs in one document only are dropped before any text moves, and
those that follow each other alike in all documents are one seed (a chain). Seeds meet by hash, with just the text around them: a passage of which an anchor is known ends less
than `window` code points beyond its outermost anchors, so extending each pair of anchors by that much
and joining what overlaps on one diagonal gives the maximal repeats exactly. How much of a document is
shared needs no pairs: anchors with equal surroundings are counted as one class, and of those that stand alone it is
asked how far some other class of the same anchor goes along with them. Exact copies of a text are
represented by one of them throughout.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headwaykit.session import written

K, WINDOW = 200, 41
BLOCK = 1 << 20  # code points hashed at once
MULTIPLIER = 0x9E3779B97F4A7C15


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the splitmix64 finaliser's published constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hasher:
    """Hashes of all k-grams of an array of code points, from prefix sums of a polynomial mod 2**64."""

    def __init__(self, k: int, block: int) -> None:
        self.k = k
        with np.errstate(over="ignore"):
            self.power = self._powers(MULTIPLIER, block)
            self.inverse = self._powers(pow(MULTIPLIER, -1, 1 << 64), block)

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        factors = np.full(n + 1, base, dtype=np.uint64)
        factors[0] = 1
        return np.cumprod(factors, dtype=np.uint64)

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        n = len(codes)
        with np.errstate(over="ignore"):
            terms = _mix(codes.astype(np.uint64) + np.uint64(1)) * self.power[:n]
            sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(terms, dtype=np.uint64)))
            return _mix((sums[self.k :] - sums[: -self.k]) * self.inverse[: n - self.k + 1])


def sliding_least(values: np.ndarray, window: int) -> np.ndarray:
    """Least value of each `window` consecutive ones, by running minima from both ends of blocks of that length."""
    n = len(values)
    blocks = -(-n // window)
    padded = np.full(blocks * window, np.iinfo(values.dtype).max, dtype=values.dtype)
    padded[:n] = values
    table = padded.reshape(blocks, window)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    back = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - window + 1], ahead[window - 1 : n])


def anchors_of(texts: list[str], hasher: Hasher, k: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of the text, hash, place) of the anchors of several texts at once: of each window the leftmost gram of least hash.

    Texts shorter than k + window - 1 have none.
    """
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32)
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    offsets = np.cumsum(lengths) - lengths
    windows = np.maximum(lengths - (k + window - 2), 0)
    total = int(windows.sum())
    if not total:
        return (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64))
    grams = hasher(codes)
    before = np.cumsum(windows) - windows
    starts = np.arange(total) + np.repeat(offsets - before, windows)
    least = sliding_least(grams, window)[starts]
    # A new least value, or a new text, begins a stretch of windows that share an anchor.
    new = np.concatenate(([True], (least[1:] != least[:-1]) | (np.diff(starts) != 1)))
    begin = np.flatnonzero(new)
    last = starts[np.concatenate((begin[1:], [total])) - 1]
    view = np.lib.stride_tricks.sliding_window_view(grams, window)
    first = starts[begin]
    place = view[first].argmin(axis=1) + first
    # Where windows outlive their anchor the value occurs again: those windows are looked at one by one.
    more = [view[p + 1 : e + 1].argmin(axis=1) + np.arange(p + 1, e + 1) for p, e in zip(place[place < last].tolist(), last[place < last].tolist())]
    place = np.unique(np.concatenate([place, *more]))
    text = np.searchsorted(offsets, place, side="right") - 1
    return text, grams[place], place - offsets[text]


def series(texts: np.ndarray, hashes: np.ndarray, places: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """(text, hash, place, run, step): a text's anchors of one hash that follow each other within the window as one row.

    Grams that overlap their equals make a periodic stretch (one letter over and over, say): from place
    to place + run + k the text repeats with period step. A lone anchor has run and step 0.
    """
    if not len(hashes):
        return texts, hashes, places, places, places
    order = np.lexsort((places, hashes, texts))
    d, h, p = texts[order], hashes[order], places[order]
    gap = np.diff(p)
    near = (d[1:] == d[:-1]) & (h[1:] == h[:-1]) & (gap <= window)
    begin = np.flatnonzero(np.concatenate(([True], ~near)))
    end = np.concatenate((begin[1:], [len(h)])) - 1
    step = np.zeros(len(begin), dtype=np.int64)
    for i in np.flatnonzero(end > begin):
        step[i] = gap[begin[i] : end[i]].min()
    return d[begin], h[begin], p[begin], p[end] - p[begin], step


def groups_of(texts: list[str], block: int, reach: int) -> Iterator[list[tuple[int, int, str]]]:
    """(number, offset, text) in groups of up to `block` code points; a longer text in parts that overlap by reach - 1."""
    group: list[tuple[int, int, str]] = []
    size = 0
    for number, text in enumerate(texts):
        for start in range(0, max(1, len(text) - reach + 1), block):
            part = text[start : start + block + reach - 1]
            if group and size + len(part) > block:
                yield group
                group, size = [], 0
            group.append((number, start, part))
            size += len(part)
    if group:
        yield group


ANCHOR = "hash long, doc long, place int, run int, step int"
CONTEXT = ANCHOR + ", span int, check long, left string, right string, period string"


def anchor_table(texts: list[str], hasher: Hasher, k: int, window: int, block: int = BLOCK) -> tuple[np.ndarray, ...]:
    """series of all texts."""
    found: list[list[np.ndarray]] = [[], [], []]
    for group in groups_of(texts, block, k + window - 1):
        number, offset = (np.array(x, dtype=np.int64) for x in list(zip(*group))[:2])
        part, hashes, places = anchors_of([t for _, _, t in group], hasher, k, window)
        for column, x in zip(found, (number[part], hashes, places + offset[part])):
            column.append(x)
    if not found[0]:
        return series(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64), window)
    return series(*map(np.concatenate, found), window)


def _anchors(batches: Iterator[pa.RecordBatch], k: int, window: int) -> Iterator[pa.RecordBatch]:
    hasher = Hasher(k, BLOCK + k + window)
    for batch in batches:
        ids = np.array(batch.column(0).to_pylist(), dtype=np.int64)
        number, hashes, place, run, step = anchor_table(batch.column(1).to_pylist(), hasher, k, window)
        columns = (hashes.view(np.int64), ids[number], *(x.astype(np.int32) for x in (place, run, step)))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["hash", "doc", "place", "run", "step"])


def stretch(text: str, place: int, run: int, k: int, window: int) -> tuple[int, int, int]:
    """(place, run, step) of the whole periodic stretch around an anchor, which winnowing sees only part of near its ends."""
    gram = text[place : place + k]
    step = text.find(gram, place + 1, place + window + k) - place
    if step < 0:
        step = place - text.rfind(gram, max(0, place - window), place + k - 1)
        if not 0 < step <= window or not place - step >= 0:
            return place, 0, 0
    end = place + run + k
    while len(text) >= end + step and text[end : end + step] == text[end - step : end]:
        end += step
    while place >= step and text[place - step : place] == text[place : place + step]:
        place -= step
    return place, end - k - place, step


def _contexts(batches: Iterator[pa.RecordBatch], k: int, margin: int) -> Iterator[pa.RecordBatch]:
    """Rows (doc, text, seeds) to one row per seed with what stands beside its gram (left: read backwards).

    check is a second hash of the gram (of all that a chain covers), of another kind, so that together 128 bits tell
    grams apart; period is what a periodic stretch repeats.
    """
    for batch in batches:
        rows: list[tuple] = []
        for doc, text, seeds in zip(*(batch.column(i).to_pylist() for i in range(3))):
            for h, p, run, step, span in sorted({_whole(text, seed, k, margin) for seed in seeds}):
                end = p + run + span + k
                check = int.from_bytes(hashlib.blake2b(text[p : p + span + k].encode(), digest_size=8).digest(), "big", signed=True)
                rows.append((h, doc, p, run, step, span, check, text[max(0, p - margin) : p][::-1], text[end : end + margin], text[p : p + step] if step else None))
            if len(rows) > 20_000:
                yield _context_batch(rows)
                rows = []
        if rows:
            yield _context_batch(rows)


def _whole(text: str, seed: dict, k: int, margin: int) -> tuple[int, int, int, int, int]:
    """(hash, place, run, step, span) of a seed; a lone anchor may be all that is seen of a periodic stretch, the anchors of a chain are not."""
    if seed["span"]:
        return seed["hash"], seed["place"], 0, 0, seed["span"]
    return seed["hash"], *stretch(text, seed["place"], seed["run"], k, margin + 1), 0


def _context_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.string())
    names = ["hash", "doc", "place", "run", "step", "span", "check", "left", "right", "period"]
    return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), kinds)], names=names)


def _common(a: str, b: str) -> int:
    """Length of the common start, by halving."""
    if a == b:
        return len(a)
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[:mid] == b[:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def beside(stretch: tuple, offset: int, core: int, period: str, k: int, margin: int) -> tuple[str, str]:
    """What stands left (read backwards) and right of the grams from offset to offset + core of a periodic stretch (run, step, left, right)."""
    run, _, left, right = stretch
    step = len(period)
    before = (period * (min(offset, margin) // step + 1))[::-1][: min(offset, margin)]
    rest = min(run - offset - core, margin)
    turn = (offset + core + k) % step
    after = (period * (rest // step + 2))[turn : turn + rest]
    return (before + left)[:margin], (after + right)[:margin]


def alignments(short: tuple, long: tuple, period: str, k: int, margin: int) -> Iterator[tuple[int, int, int, int]]:
    """(offset in short, offset in long, left, right): how far the repeats of two periodic stretches reach.

    short and long are (run, step, left, right). The short stretch is laid on the first and the last place
    of the long one, at places between that together cover it, and one period beyond either end, where what
    is left of a period at the other's edge finds its like. Which repeats there are besides, and they are
    many, all lie within these.
    """
    step = len(period)
    run, whole = short[0], long[0]
    stride = (run + k) // step * step
    for shift in dict.fromkeys([-step, 0, *range(stride, whole - run, stride), whole - run, whole - run + step]):
        a, b = max(0, -shift), max(0, shift)
        core = min(run - a, whole - b)
        if core >= 0:
            (left_a, right_a), (left_b, right_b) = (beside(x, at, core, period, k, margin) for x, at in ((short, a), (long, b)))
            yield a, b, _common(left_a, left_b), core + _common(right_a, right_b)


#: What a pair of seeds brings: where they are, how much stands beside both where that is alike, and the surroundings only where it is not.
PAIR = ["doc_x", "doc_y", "place_x", "place_y", "left", "right", "span", "run_x", "run_y", "step_x", "step_y", "left_x", "left_y", "right_x", "right_y", "period_x", "period_y"]


def _extend(batches: Iterator[pa.RecordBatch], k: int, margin: int) -> Iterator[pa.RecordBatch]:
    """Pairs of seeds to repeats (doc_a, doc_b, diagonal, start_a, end_a)."""
    names = ["doc_a", "doc_b", "diagonal", "start_a", "end_a"]
    for batch in batches:
        alike = batch.column(4).is_valid()
        plain = batch.filter(alike)
        if plain.num_rows:
            a, b, p, q, left, right, span = (plain.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(7))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (a, b, p - q, p - left, p + span + k + right)], names=names)
        out: list[tuple[int, int, int, int, int]] = []
        for a, b, p, q, _, _, span, run_a, run_b, step_a, step_b, left_a, left_b, right_a, right_b, period_a, period_b in zip(*(c.to_pylist() for c in batch.filter(pc.invert(alike)).columns)):
            if not run_a and not run_b:
                out.append((a, b, p - q, p - _common(left_a, left_b), p + span + k + _common(right_a, right_b)))
                continue
            period = min(filter(None, (period_a, period_b)), key=len)
            one, two = (run_a, step_a, left_a, right_a), (run_b, step_b, left_b, right_b)
            if run_a <= run_b:
                found = ((p + x, q + y, left, right) for x, y, left, right in alignments(one, two, period, k, margin))
            else:
                found = ((p + y, q + x, left, right) for x, y, left, right in alignments(two, one, period, k, margin))
            out += [(a, b, at_a - at_b, at_a - left, at_a + k + right) for at_a, at_b, left, right in found]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=names)


def text_classes(documents: DataFrame, id_column: str, text: str, least: int) -> DataFrame:
    """(doc, rep): each document of at least `least` code points with the smallest id among its exact copies."""
    long = documents.where(F.char_length(text) >= least).select(F.col(id_column).cast("long").alias("doc"), F.sha2(text, 256).alias("_text"))
    reps = long.groupBy("_text").agg(F.min("doc").alias("rep"))
    return long.join(reps, "_text").select("doc", "rep")


def seed_contexts(documents: DataFrame, classes: DataFrame, id_column: str = "doc_id", text: str = "text", k: int = K, window: int = WINDOW) -> DataFrame:
    """The anchors that several representatives have, with what stands beside them; written, since its readers read it more than once.

    classes: of text_classes, with k + window - 1 as the least length. Texts are compared as they stand.
    """
    if window > k:
        raise ValueError("window must not exceed k")
    reps = classes.where("doc = rep").select("doc")
    # Ids repeat only if rows do, and anchors or contexts given twice change nothing below.
    texts = documents.select(F.col(id_column).cast("long").alias("doc"), F.make_valid_utf8(text).alias("text")).where(F.char_length("text") >= k + window - 1)
    used = texts.join(reps, "doc", "left_semi")
    anchors = written(used.mapInArrow(partial(_anchors, k=k, window=window), ANCHOR), "anchors")
    repeated = anchors.groupBy("hash").agg(F.min("doc").alias("a"), F.max("doc").alias("b")).where("a < b").select("hash")
    common = written(anchors.join(repeated, "hash", "left_semi"), "common")
    seeds = chains(common, k).groupBy("doc").agg(F.collect_list(F.struct("hash", "place", "run", "step", "span")).alias("seeds"))
    # collect_list is bounded by the document's own length.
    return written(used.join(seeds, "doc").select("doc", "text", "seeds").mapInArrow(partial(_contexts, k=k, margin=window - 1), CONTEXT), "contexts")


def chains(anchors: DataFrame, k: int) -> DataFrame:
    """(doc, hash, place, run, step, span): anchors that follow each other alike wherever they occur, as one seed.

    Two anchors are linked if after every occurrence of the first the second comes next, and before every occurrence of the
    second the first, at one distance of at most k, so that their grams cover all between. What n documents share
    then meets once for a passage and not once for each of its anchors. span is the way from a chain's first anchor, whose hash
    stands for it, to its last. Periodic stretches are never linked.
    """
    line = Window.partitionBy("doc").orderBy("place")
    around = anchors.withColumns({
        "_next": F.lead("hash").over(line), "_gap": F.lead("place").over(line) - F.col("place"), "_open": F.coalesce(F.lead("run").over(line) == 0, F.lit(False)) & (F.col("run") == 0),
        "_before": F.lag("hash").over(line), "_back": F.col("place") - F.lag("place").over(line), "_shut": F.coalesce(F.lag("run").over(line) == 0, F.lit(False)) & (F.col("run") == 0),
    })
    one = lambda c: F.min(c) == F.max(c)
    ways = around.groupBy("hash").agg(
        F.when(one("_next") & one("_gap") & F.min("_open") & (F.max("_gap") <= k), F.max("_next")).alias("next"), F.max("_gap").alias("gap"),
        F.when(one("_before") & one("_back") & F.min("_shut"), F.max("_before")).alias("before"), F.max("_back").alias("back"),
    )
    x, y = ways.alias("x"), ways.alias("y")
    linked = x.join(y, (F.col("x.next") == F.col("y.hash")) & (F.col("y.before") == F.col("x.hash")) & (F.col("x.gap") == F.col("y.back"))).select(F.col("y.hash").alias("hash"), F.lit(True).alias("_linked"))
    marked = anchors.join(linked, "hash", "left").withColumn("_head", F.col("_linked").isNull())
    numbered = marked.withColumn("_chain", F.sum(F.col("_head").cast("int")).over(line))
    head = lambda c: F.max(F.when(F.col("_head"), F.col(c))).alias(c)
    return numbered.groupBy("doc", "_chain").agg(head("hash"), F.min("place").alias("place"), head("run"), head("step"), (F.max("place") - F.min("place")).cast("int").alias("span")).drop("_chain")


def shared_spans(contexts: DataFrame, least: int = 240, k: int = K, window: int = WINDOW) -> DataFrame:
    """Maximal repeats between representatives: doc_a < doc_b, start_a, start_b, length (code points, at least `least`).

    contexts: of seed_contexts with the same k and window; k + window - 1 must not exceed `least`. Null, empty
    and short texts share nothing; repeats inside one document are none.
    """
    if k + window - 1 > least:
        raise ValueError("k + window - 1 must not exceed the least length")
    x, y = contexts.alias("x"), contexts.alias("y")
    same = (F.col("x.hash") == F.col("y.hash")) & (F.col("x.check") == F.col("y.check")) & (F.col("x.doc") < F.col("y.doc"))
    alike = (F.col("x.run") == 0) & (F.col("y.run") == 0) & (F.col("x.left") == F.col("y.left")) & (F.col("x.right") == F.col("y.right"))
    beside = {c: F.when(alike, F.char_length(f"x.{c}")) for c in ("left", "right")}
    both = {f"{c}_{side}": F.col(f"{side}.{c}") for c in ("doc", "place", "run", "step", "left", "right", "period") for side in "xy"}
    texts = {c: F.when(~alike, both[c]) for c in PAIR[11:]}
    met = x.join(y, same).select(*[({**both, **beside, **texts, "span": F.col("x.span")})[c].alias(c) for c in PAIR])
    pieces = met.mapInArrow(partial(_extend, k=k, margin=window - 1), "doc_a long, doc_b long, diagonal long, start_a long, end_a long")
    line = Window.partitionBy("doc_a", "doc_b", "diagonal").orderBy("start_a", "end_a")
    reach = F.max("end_a").over(line.rowsBetween(Window.unboundedPreceding, -1))
    numbered = pieces.withColumn("_new", F.when(F.col("start_a") <= reach, 0).otherwise(1)).withColumn("_no", F.sum("_new").over(line))
    spans = numbered.groupBy("doc_a", "doc_b", "diagonal", "_no").agg(F.min("start_a").alias("start_a"), F.max("end_a").alias("end_a"))
    return spans.where(F.col("end_a") - F.col("start_a") >= least).select(
        "doc_a", "doc_b", "start_a", (F.col("start_a") - F.col("diagonal")).alias("start_b"), (F.col("end_a") - F.col("start_a")).alias("length")
    )


def _occurrences(batches: Iterator[pa.RecordBatch], k: int, margin: int) -> Iterator[pa.RecordBatch]:
    """Contexts to (hash, check, doc, first, last, left, right): the places of a gram; one row for those inside a periodic stretch, which have equal surroundings."""
    names = ["hash", "check", "doc", "first", "last", "span", "left", "right"]
    for batch in batches:
        rows: list[tuple] = []
        for h, doc, p, run, step, span, check, left, right, period in zip(*(c.to_pylist() for c in batch.columns)):
            if not run:
                rows.append((h, check, doc, p, p + span, span, left, right))
                continue
            turns, near = run // step, -(-margin // step)
            inner = range(near, turns - near + 1)
            for i in [*range(min(near, turns + 1)), *inner[:1], *range(max(near, turns - near + 1), turns + 1)]:
                last = inner[-1] if len(inner) and i == near else i
                rows.append((h, check, doc, p + i * step, p + last * step, 0, *beside((run, step, left, right), i * step, 0, period, k, margin)))
        yield pa.RecordBatch.from_arrays([pa.array(c, type=pa.string() if n in ("left", "right") else pa.int64()) for c, n in zip(list(zip(*rows)) or [[]] * 8, names)], names=names)


def shared_stretches(contexts: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """(doc, s, e): stretches of representatives that together are all that they share, in runs of at least k + window - 1, with others.

    No pairs: a stretch of that length has an anchor at the same place in it wherever it occurs. Anchors with
    equal surroundings are a class; where its members are of several documents, all around them is shared. A class
    of one document is shared as far as another class of the same anchor has the same `a` code points before and
    the same window - 1 - a after it, for some a. Both are aggregates, so a passage in n documents costs n rows.
    Surroundings are told apart by 128 bits of hash.
    """
    margin = window - 1
    fields = "hash long, check long, doc long, first long, last long, span long, left string, right string"
    places = contexts.select("hash", "doc", "place", "run", "step", "span", "check", "left", "right", "period").mapInArrow(partial(_occurrences, k=k, margin=margin), fields)
    around = [F.xxhash64(F.lit(seed), "left", F.lit("|"), "right").alias(f"c{seed}") for seed in (1, 2)]
    key = ["hash", "check", "c1", "c2"]
    placed = written(places.select("hash", "check", *around, "doc", "first", "last", "span", "left", "right"), "places")
    classes = placed.groupBy(*key).agg(
        F.min("doc").alias("a"), F.max("doc").alias("b"), F.first("left").alias("left"), F.first("right").alias("right"), F.max("span").alias("span")
    )  # any member's texts: they are equal
    before, after = F.char_length("left"), F.char_length("right")
    classes = classes.where(before + after + F.col("span") >= margin)
    whole = classes.where("a < b").select(*key, before.alias("x"), after.alias("y"))
    several = classes.groupBy("hash", "check").agg(F.count("*").alias("n")).where("n > 1").select("hash", "check")
    # How much before and after the gram makes up the length: x before asks for the rest after, and the other way round.
    rest = lambda n: F.greatest(F.lit(0), F.lit(margin) - n - F.col("span").cast("int"))
    left = F.transform(F.sequence(rest(after), before), lambda x: F.struct(x.alias("x"), rest(x).alias("y")))
    right = F.transform(F.sequence(rest(before), after), lambda y: F.struct(rest(y).alias("x"), y.alias("y")))
    asked = classes.join(several, ["hash", "check"], "left_semi").select("*", F.explode(F.array_distinct(F.concat(left, right))).alias("at")).select("*", "at.*")
    part = F.concat(F.left("left", F.col("x")), F.lit("|"), F.left("right", F.col("y")))
    views = asked.select(*key, "a", "b", "x", "y", *[F.xxhash64(F.lit(seed), part).alias(f"w{seed}") for seed in (3, 4)])
    view = ["hash", "check", "x", "y", "w3", "w4"]
    met = views.groupBy(*view).agg(F.min("a").alias("a"), F.max("b").alias("b")).where("a < b").select(*view)
    single = views.where("a = b").join(met, view, "left_semi").groupBy(*key).agg(F.max("x").alias("x"), F.max("y").alias("y"))
    spans = whole.unionByName(single)
    return placed.select(*key, "doc", "first", "last").join(spans, key).select("doc", (F.col("first") - F.col("x")).alias("s"), (F.col("last") + k + F.col("y")).alias("e"))


def sharing_pairs(spans: DataFrame, classes: DataFrame) -> DataFrame:
    """All pairs doc_a < doc_b of documents that share a span, exact copies included."""
    pairs = spans.select("doc_a", "doc_b").distinct()
    member = lambda side: classes.select(F.col("rep").alias(f"_{side}"), F.col("doc").alias(side))
    several = classes.groupBy("rep").agg(F.count("*").alias("n"))
    across = pairs.withColumnsRenamed({"doc_a": "_x", "doc_b": "_y"}).join(member("x"), "_x").join(member("y"), "_y").select("x", "y")
    copies = several.where("n > 1").select(F.col("rep").alias("_x"), F.col("rep").alias("_y"))
    within = copies.join(member("x"), "_x").join(member("y"), "_y").where("x < y").select("x", "y")
    return across.unionByName(within).select(F.least("x", "y").alias("doc_a"), F.greatest("x", "y").alias("doc_b"))


def shared_amounts(documents: DataFrame, stretches: DataFrame, classes: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_chars, shared_chars, copies for every document: how much of it stands in other documents too.

    Overlapping stretches count once; a text that another document has as a whole is shared as a whole.
    """
    sides = stretches.select("doc", "s", "e").distinct()
    line = Window.partitionBy("doc").orderBy("s", "e").rowsBetween(Window.unboundedPreceding, -1)
    covered = sides.withColumn("_until", F.coalesce(F.max("e").over(line), F.lit(0))).groupBy("doc").agg(
        F.sum(F.greatest(F.col("e") - F.greatest("s", "_until"), F.lit(0))).alias("covered")
    )
    sizes = classes.groupBy("rep").agg((F.count("*") - 1).alias("copies"))
    facts = classes.join(sizes, "rep").join(covered.withColumnRenamed("doc", "rep"), "rep", "left").select("doc", "copies", "covered")
    length = F.coalesce(F.char_length(text), F.lit(0))
    rows = documents.select(F.col(id_column), F.col(id_column).cast("long").alias("doc"), length.cast("long").alias("n_chars"))
    return rows.join(facts, "doc", "left").select(
        id_column, "n_chars",
        F.when(F.col("copies") > 0, F.col("n_chars")).otherwise(F.coalesce("covered", F.lit(0))).cast("long").alias("shared_chars"),
        F.coalesce("copies", F.lit(0)).cast("long").alias("copies"),
    )
