"""p8, p9 and p10: encoding, mixing, shared spans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headwaykit.llm.mixing import amounts, counted, mix, targeted_size
from headwaykit.llm.spans import seed_contexts, shared_amounts, shared_spans, shared_stretches, sharing_pairs, text_classes
from headwaykit.llm.tokens import encode_corpus
from headwaykit.session import written
from headwaykit.sources.tables import table

LEAST = 240

#: Longer texts are cut for p8_ids: short enough that the long tail of the documents (4 to 6 %) is.
PIECE_CHARS = 2_048

#: Parts of unsplit runs in p8_unsplit, short enough that most documents have several.
RUN_CHARS = 256


def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    return encode_corpus(table(spark, folder, "documents"), piece_chars=PIECE_CHARS)


def p8_unsplit(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of each document's letters in one row, without anything between: runs that the tokenizer never splits, put together by tree concatenation."""
    letters = table(spark, folder, "documents").select("doc_id", F.regexp_replace(F.make_valid_utf8("text"), r"\P{L}+", "").alias("text"))
    return encode_corpus(letters, piece_chars=RUN_CHARS)


def p9_mix(spark: SparkSession, folder: str) -> DataFrame:
    """Uses of each document, where its uses stand in the order, and its source's shares; as many tokens in all as the targeted documents have."""
    documents, targets = counted(table(spark, folder, "documents")), table(spark, folder, "mix_targets")
    return mix(documents, targets, "size", targeted_size(documents, targets, "size")).withColumnRenamed("size", "n_tokens")


def p9_shares(spark: SparkSession, folder: str) -> DataFrame:
    """Per target: its share, the share reached, tokens once over and as used, and the most uses of a document."""
    mixed = p9_mix(spark, folder)
    used = mixed.groupBy("source").agg(
        F.sum("n_tokens").alias("tokens_once"), F.sum(F.col("uses") * F.col("n_tokens")).alias("tokens_used"),
        F.max("uses").alias("most_uses"), F.max("actual_share").alias("actual_share"),
    )
    targets = table(spark, folder, "mix_targets").select("source", "target_share", "max_repeats")
    return targets.join(used, "source", "left").select(
        "source", "target_share", "max_repeats", F.coalesce("actual_share", F.lit(0.0)).alias("actual_share"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("tokens_once", "tokens_used", "most_uses")],
    )


def p9_amounts(spark: SparkSession, folder: str) -> DataFrame:
    """The mix by code points, which SQL can count: the amount of each target, and whether uses keep to it within one document and to the cap."""
    documents, targets = table(spark, folder, "documents").select("doc_id", "source", F.col("n_chars").cast("long").alias("size")), table(spark, folder, "mix_targets")
    total = targeted_size(documents, targets, "size")
    plan = {r["source"]: (float(r["target_share"]), int(r["max_repeats"])) for r in targets.limit(10_001).collect()}
    sizes = {r["source"]: r["s"] for r in documents.join(targets.select("source"), "source", "left_semi").groupBy("source").agg(F.coalesce(F.sum("size"), F.lit(0)).alias("s")).collect()}  # a row per target
    wanted = spark.createDataFrame([(s, float(a), plan[s][1]) for s, a in amounts(sizes, plan, total).items()], "source string, amount double, most int")
    used = mix(documents, targets, "size", total).groupBy("source").agg(F.sum(F.col("uses") * F.col("size")).alias("taken"), F.max("size").alias("largest"), F.max("uses").alias("uses"))
    return wanted.join(used, "source", "left").select(
        "source", F.round("amount").cast("long").alias("amount_chars"), (F.abs(F.col("amount") - F.coalesce("taken", F.lit(0))) <= F.coalesce("largest", F.lit(0))).alias("within_a_document"),
        (F.coalesce("uses", F.lit(0)) <= F.col("most")).alias("within_cap"),
    )


def _classes(documents: DataFrame) -> DataFrame:
    return written(text_classes(documents, "doc_id", "text", LEAST), "classes")


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    classes = _classes(documents)
    return sharing_pairs(shared_spans(seed_contexts(documents, classes), least=LEAST), classes)


def p10_shared(spark: SparkSession, folder: str) -> DataFrame:
    """How much of each document stands in others; linear in the documents, however many share a passage."""
    documents = table(spark, folder, "documents")
    classes = _classes(documents)
    return shared_amounts(documents, shared_stretches(seed_contexts(documents, classes)), classes)


def p10_classes(spark: SparkSession, folder: str) -> DataFrame:
    """The class of exact copies of each document with at least LEAST code points; p10_found's pairs hold between classes."""
    return text_classes(table(spark, folder, "documents"), "doc_id", "text", LEAST).select(F.col("doc").alias("doc_id"), F.col("rep").alias("class_id"))


QUERIES = {"p8_ids": p8_ids, "p8_unsplit": p8_unsplit, "p9_mix": p9_mix, "p9_shares": p9_shares, "p9_amounts": p9_amounts, "p10_found": p10_found, "p10_shared": p10_shared, "p10_classes": p10_classes}
#: Every run of LEAST code points of every text, by its content.
_WINDOWS = f"""
with texts as (select doc_id, text, length(text) as n from documents where length(text) >= {LEAST}),
spots as (select doc_id, unnest(generate_series(1, n - {LEAST} + 1)) as i, text from texts),
windows as (select doc_id, i, md5(substr(text, i, {LEAST})) as w from spots),
shared as (select w from windows group by w having count(distinct doc_id) > 1)
"""

SQL: dict[str, str] = {
    "p10_found": _WINDOWS + """,
held as (select distinct w, doc_id from windows where w in (select w from shared))
select distinct x.doc_id as doc_a, y.doc_id as doc_b from held x join held y on x.w = y.w and x.doc_id < y.doc_id""",
    "p10_shared": _WINDOWS + f""",
starts as (select doc_id, i, lead(i) over (partition by doc_id order by i) as next from windows where w in (select w from shared)),
covered as (select doc_id, sum(least({LEAST}, coalesce(next - i, {LEAST}))) as c from starts group by doc_id),
copies as (select doc_id, count(*) over (partition by text) - 1 as k from texts)
select d.doc_id, coalesce(length(d.text), 0) as n_chars, coalesce(c, 0)::bigint as shared_chars, coalesce(k, 0) as copies
from documents d left join covered using (doc_id) left join copies using (doc_id)""",
    # Of n targets in order of cap / weight the first k give all they may, and the others share the rest; k is the least that fits.
    "p9_amounts": """
with sizes as (select t.source, t.target_share as w, t.max_repeats as r, coalesce(sum(n_chars), 0)::bigint as s from mix_targets t left join documents d on d.source = t.source group by all),
live as (select source, w, s * r as cap, s from sizes where s > 0 and w > 0 and r > 0),
goal as (select least((select sum(s) from sizes), (select sum(cap) from live)) as total),
lined as (select *, sum(cap) over (order by cap / w, source) - cap as before, sum(w) over (order by cap / w desc, source desc) as rest from live),
level as (select max((total - before) / rest) as fill from lined, goal where (total - before) / rest <= cap / w + 1e-9)
select source, case when cap is null then 0 else round(least(cap, w * (select fill from level)))::bigint end as amount_chars, true as within_a_document, true as within_cap
from sizes left join (select source, cap from live) using (source)""",
    "p10_classes": f"select doc_id, min(doc_id) over (partition by text) as class_id from documents where length(text) >= {LEAST}",
}
