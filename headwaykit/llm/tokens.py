"""Encoding a corpus with a public byte-level BPE tokenizer, exact also for very long texts.

Texts up to piece_chars are encoded as they are. Longer ones are cut and encoded in parallel: at places
where the tokenizer's own splitting always has a border (then the ids simply follow each other), or,
inside a run that it never splits, anywhere. The ids of such a run are put together by tree
concatenation: around each join a window of tokens is encoded again and widened until its first and
last tokens are those of the two sides. The tree goes over tasks: blocks of pieces are joined where they are
encoded, and only what they leave meets. A sequence of BPE tokens is the encoding of its bytes if and
only if every two neighbours are the encoding of theirs, so the result is then exact.
"""

from __future__ import annotations

import base64
import hashlib
import unicodedata
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: what the tokenizer splits texts by before it merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


#: Pieces of a text that one task encodes and joins; the tree's next level joins what these leave.
BLOCK_PIECES = 64


def vocabulary_file() -> str:
    """Place of the rank file on this machine; any other path can be given instead."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def encoder(ranks: bytes):
    """The tokenizer of a rank file's content, made once per worker process."""
    import tiktoken

    name = "ranks-" + hashlib.sha256(ranks).hexdigest()[:16]
    # Functions come to a worker anew with each task; what outlives a task there is the imported module.
    cache = tiktoken.__dict__.setdefault("_encoders_by_ranks", {})
    if name not in cache:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines()) if a}
        cache[name] = tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
    return cache[name]


def encode_run(enc, data: bytes) -> list[int]:
    """Ids of one unsplit run. Only here is a method used that the tokenizer's library does not declare public."""
    method = getattr(enc, "_encode_single_piece", None)
    if method is None:
        raise RuntimeError("this version of tiktoken cannot encode a run of bytes without splitting it; 0.5 and later can")
    return method(data)


def kind(c: str) -> str:
    """Letter, number, space or other; ? where versions of Unicode may differ."""
    if c.isspace() or c in "\x85":
        return "s" if c not in "\x1c\x1d\x1e\x1f" else "?"
    category = unicodedata.category(c)
    if category in ("Cn", "Co") or ord(c) > 0x1FFFF:
        return "?"
    return "l" if category[0] == "L" else "n" if category[0] == "N" else "o"


def border(before: str, after: str) -> bool:
    """Whether the splitting has a border between two characters whatever surrounds them."""
    a, b = kind(before), kind(after)
    return a not in "s?" and b != "?" and a != b and not (before == "'" and b == "l")


def pieces(text: str, size: int) -> Iterator[tuple[bool, str]]:
    """(inner, piece): cuts a text at borders, and runs longer than `size` that have none anywhere.

    inner pieces that follow each other are parts of one unsplit run. A long stretch without borders
    that is not one plain run stays whole.
    """
    start, n = 0, len(text)
    while n - start > size:
        end = start + size
        cut = next((i for i in range(end, max(start, end - 1024), -1) if border(text[i - 1], text[i])), None)
        if cut is None:
            stop = next((i for i in range(end + 1, n) if border(text[i - 1], text[i])), n)
            first = next((i for i in range(max(start, end - 1024), start, -1) if border(text[i - 1], text[i])), start)
            run = text[first:stop]
            spaces = next((i for i, c in enumerate(run) if kind(c) != "s"), len(run))
            body = run[spaces:]
            lead = spaces - (spaces > 0 and run[spaces - 1] == " ")
            plain = {kind(c) for c in body}
            if len(plain) == 1 and plain <= {"l", "n", "o"} and "'" not in body and len(body) > size:
                # Of several spaces before a run the last one stands apart from the others (or belongs to the run).
                alone = lead > 1 and lead == spaces
                if first + lead - alone > start:
                    yield False, text[start : first + lead - alone]
                if alone:
                    yield False, run[lead - 1]
                core = run[lead:]
                for i in range(0, len(core), size):
                    yield True, core[i : i + size]
            else:
                yield False, text[start:stop]
            start = stop
        else:
            yield False, text[start:cut]
            start = cut
    if start < n:
        yield False, text[start:]


def join_ids(left: list[int], right: list[int], enc) -> list[int]:
    """Ids of the joined bytes of one unsplit run, from the ids of its halves."""
    if not left or not right:
        return left or right
    width = 4
    while True:
        a, b = min(width, len(left)), min(width, len(right))
        window = encode_run(enc, enc.decode_bytes(left[-a:]) + enc.decode_bytes(right[:b]))
        whole_left, whole_right = a == len(left), b == len(right)
        if (whole_left or window[0] == left[-a]) and (whole_right or window[-1] == right[b - 1]):
            return left[: len(left) - a] + window + right[b:]
        width *= 2


def concatenate(parts: list[list[int]], enc) -> list[int]:
    """Joins the parts of one run in a balanced tree."""
    while len(parts) > 1:
        parts = [join_ids(parts[i], parts[i + 1], enc) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0] if parts else []


def encode_long(text: str, enc, size: int) -> list[int]:
    """What the distributed way gives, on one machine; the tests hold it against the tokenizer itself."""
    out: list[int] = []
    run: list[list[int]] = []
    for inner, piece in pieces(text, size):
        if inner:
            run.append(encode_run(enc, piece.encode()))
            continue
        out += concatenate(run, enc)
        run = []
        out += enc.encode_ordinary(piece)
    return out + concatenate(run, enc)


def _encode(batches: Iterator[pa.RecordBatch], ranks, counts: bool) -> Iterator[pa.RecordBatch]:
    enc = encoder(ranks.value)
    for batch in batches:
        ids = [enc.encode_ordinary(t) if t else [] for t in batch.column(1).to_pylist()]
        yield _ids_batch(batch.column(0), ids, counts)


def _ids_batch(doc: pa.Array, ids: list[list[int]], counts: bool) -> pa.RecordBatch:
    value = pa.array([len(x) for x in ids], type=pa.int64()) if counts else pa.array(ids, type=pa.list_(pa.int32()))
    return pa.RecordBatch.from_arrays([doc, value], names=["id", "ids"])


def _cut(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for doc, text in zip(batch.column(0), batch.column(1).to_pylist()):
            rows = [(n, inner, piece) for n, (inner, piece) in enumerate(pieces(text, size))]
            no, inner, piece = map(list, zip(*rows))
            digest = hashlib.sha256(text.encode()).digest()
            yield pa.RecordBatch.from_arrays(
                [pa.array([doc.as_py()] * len(rows), type=batch.schema.field(0).type), pa.array([digest] * len(rows), pa.binary()), pa.array(no, pa.int32()), pa.array(inner, pa.bool_()), pa.array(piece, pa.string())],
                names=["id", "digest", "no", "inner", "text"],
            )


def fold(pieces: list[tuple[bool, list[int]]], enc) -> list[tuple[bool, list[int]]]:
    """(inner, ids) of consecutive pieces to at most three: what may go on before them, what is settled, what may go on after them."""
    first = next((i for i, (inner, _) in enumerate(pieces) if not inner), len(pieces))
    last = next((i for i in range(len(pieces), 0, -1) if not pieces[i - 1][0]), first)
    settled: list[int] = []
    run: list[list[int]] = []
    for inner, ids in pieces[first:last]:
        if inner:
            run.append(ids)
            continue
        settled += concatenate(run, enc)
        run = []
        settled += ids
    parts = [(True, concatenate([ids for _, ids in pieces[:first]], enc))] if first else []
    parts += [(False, settled)] if last > first else []
    return parts + ([(True, concatenate([ids for _, ids in pieces[last:]], enc))] if last < len(pieces) else [])


def _encode_blocks(batches: Iterator[pa.RecordBatch], ranks) -> Iterator[pa.RecordBatch]:
    """Encodes pieces and folds those of a block; they come sorted by document, text, block and number.

    A piece given k times (its text was) is encoded once; what its block folds to leaves k times.
    """
    enc, open_block, last, copies, held, kind_of = encoder(ranks.value), None, -1, 0, [], None
    rows: list[tuple] = []

    def close() -> None:
        if held:
            number = held[0][0]
            for n, (inner, ids) in enumerate(fold([(inner, ids) for _, inner, ids in held], enc)):
                rows.extend([(*open_block[:2], number + n, inner, ids)] * copies)  # a block has at least as many pieces as it folds to

    def flush() -> pa.RecordBatch:
        doc, digest, no, inner, ids = zip(*rows)
        rows.clear()
        arrays = [pa.array(doc, type=kind_of), pa.array(digest, pa.binary()), pa.array(no, pa.int32()), pa.array(inner, pa.bool_()), pa.array(ids, type=pa.list_(pa.int32()))]
        return pa.RecordBatch.from_arrays(arrays, names=["id", "digest", "no", "inner", "ids"])

    for batch in batches:
        kind_of = batch.schema.field(0).type
        for doc, digest, no, inner, text, block in zip(*(batch.column(i).to_pylist() for i in range(6))):
            if (doc, digest, block) != open_block:
                close()
                open_block, last, copies, held = (doc, digest, block), -1, 0, []
                if sum(len(r[4]) for r in rows) > 500_000:
                    yield flush()
            if no == last:
                copies += len(held) == 1
                continue
            last, copies = no, copies or 1
            held.append((no, inner, encode_run(enc, text.encode()) if inner else enc.encode_ordinary(text)))
    close()
    if rows:
        yield flush()


def _assemble(batches: Iterator[pa.RecordBatch], ranks, counts: bool) -> Iterator[pa.RecordBatch]:
    """Pieces come sorted by document, text and number; a document's ids are one row in the end, so they fit.

    A text given k times under one id has each of its pieces k times in a row: one is taken, k rows leave.
    """
    enc, kind_of, open_text, last, copies, out, run = encoder(ranks.value), None, None, -1, 0, [], []
    done: list[tuple] = []

    def close() -> None:
        if copies:
            done.extend([(open_text[0], out + concatenate(run, enc))] * copies)

    def flush() -> pa.RecordBatch:
        ids = _ids_batch(pa.array([d for d, _ in done], type=kind_of), [i for _, i in done], counts)
        done.clear()
        return ids

    for batch in batches:
        kind_of = batch.schema.field(0).type
        for doc, digest, no, inner, ids in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if (doc, digest) != open_text:
                close()
                open_text, last, copies, out, run = (doc, digest), -1, 0, [], []
                if sum(len(i) for _, i in done) > 500_000:
                    yield flush()
            copies += no == 0
            if no == last:
                continue
            last = no
            if inner:
                run.append(ids)
            else:
                out += concatenate(run, enc)
                run = []
                out += ids
    close()
    if done:
        yield flush()


def encode_corpus(documents: DataFrame, id_column: str = "doc_id", text: str = "text", vocabulary: str | None = None, piece_chars: int = 8192, counts: bool = False) -> DataFrame:
    """(id_column, ids) of every row; with counts ids is their number only, as a long.

    An empty text and a null one have no ids. Bytes that are not UTF-8 count as U+FFFD. Special tokens'
    strings are ordinary text. Rows of one id give a row each, whatever their length; other columns are
    ignored. The vocabulary (under 1 MB) is read on the driver and sent to the workers.
    """
    spark = documents.sparkSession
    with open(vocabulary or vocabulary_file(), "rb") as f:
        ranks = spark.sparkContext.broadcast(f.read())
    picked = documents.select(F.col(id_column).alias("id"), F.make_valid_utf8(F.col(text)).alias("text"))
    key = dict(picked.dtypes)["id"]
    schema = f"id {key}, ids {'bigint' if counts else 'array<int>'}"
    is_long = F.coalesce(F.char_length("text"), F.lit(0)) > piece_chars
    short = picked.where(~is_long).mapInArrow(partial(_encode, ranks=ranks, counts=counts), schema)
    parts = picked.where(is_long).mapInArrow(partial(_cut, size=piece_chars), f"id {key}, digest binary, no int, inner boolean, text string")
    blocks = parts.withColumn("block", F.floor(F.col("no") / F.lit(BLOCK_PIECES)).cast("int")).repartition("id", "digest", "block").sortWithinPartitions("id", "digest", "block", "no")
    encoded = blocks.mapInArrow(partial(_encode_blocks, ranks=ranks), f"id {key}, digest binary, no int, inner boolean, ids array<int>")
    long = encoded.repartition("id").sortWithinPartitions("id", "digest", "no").mapInArrow(partial(_assemble, ranks=ranks, counts=counts), schema)
    return short.unionByName(long).withColumnRenamed("id", id_column)
