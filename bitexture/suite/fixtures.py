"""Inputs of the registered queries, derived from the given tables in Spark and, identically, in SQL.

pairs        conversation turns with the turn that follows, and two scores
noisy_pairs  pairs with copies and missing sides
extremes     scores of pairs, some infinite or no numbers
with_references  examples with one to three references
examples     pairs as evaluation examples with damaged targets as predictions
corpus       documents as monolingual texts
labelled     documents with their quality label and a given split
run_log      events as step losses of training runs, some NaN
tokens       embedding vectors as logits, with labels
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bitexture.functions.hashing import seeded_hash

SRC_LANG, TRG_LANG = "en", "fr"
VOCABULARY = 64
SEQUENCE = 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    source = turns.select("conv_id", "turn", "role", F.col("text").alias("src_text"))
    target = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("trg_text"))
    joined = source.join(target, ["conv_id", "turn"]).withColumn("pair_id", F.col("conv_id") * 100000 + F.col("turn"))
    h = seeded_hash("pair_id", "quality")
    lengths = [F.length("src_text"), F.length("trg_text")]
    return joined.select(
        "pair_id",
        "src_text",
        "trg_text",
        F.when(h % 37 != 0, (h % 1001) / F.lit(1000.0)).alias("bicleaner_ai_score"),
        (F.floor(F.try_divide(F.least(*lengths) * F.lit(1000.0), F.greatest(*lengths))) / F.lit(1000.0)).alias(
            "bleualign_score"
        ),
        F.col("role").alias("dataset"),
    )


def extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of which some are infinite or no numbers."""
    kind = seeded_hash("pair_id", "extremes") % 40
    x = F.when(kind == 0, float("inf")).when(kind == 1, float("-inf")).when(kind == 2, float("nan"))
    return pairs(spark, sf_dir).select("pair_id", x.otherwise(F.coalesce("bicleaner_ai_score", F.lit(0.5))).alias("x"))


def noisy_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = seeded_hash("pair_id", "copies")
    copies = pairs(spark, sf_dir).withColumn("copy", F.explode(F.sequence(F.lit(0), (h % 4).cast("int"))))
    return copies.select(
        (F.col("pair_id") * 4 + F.col("copy")).alias("pair_id"),
        "src_text",
        F.when(F.col("copy") != 3, F.col("trg_text")).alias("trg_text"),
    )


def damaged(text: Column, key: Column) -> Column:
    kind = seeded_hash(key, "damage") % 6
    half = F.floor(F.length(text) / 2).cast("int")
    return (
        F.when(kind == 0, text)
        .when(kind == 1, F.replace(text, F.lit("e"), F.lit("a")))
        .when(kind == 2, F.concat(F.substring(text, half + 1, F.length(text)), F.lit(" "), F.substring(text, F.lit(1), half)))
        .when(kind == 3, F.replace(text, F.lit("th"), F.lit("d")))
        .when(kind == 4, F.substring(text, F.lit(1), half))
        .otherwise(F.when(seeded_hash(key, "empty") % 5 == 0, "").otherwise(F.replace(text, F.lit(" "), F.lit("  "))))
    )


def examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs(spark, sf_dir).select(
        F.lit("suite").alias("experiment"),
        F.lit("r1").alias("run_id"),
        "dataset",
        F.col("pair_id").alias("example_id"),
        F.col("src_text").alias("inputs"),
        F.col("trg_text").alias("outputs"),
        damaged(F.col("trg_text"), F.col("pair_id")).alias("predictions"),
    )


def with_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The examples with one to three references each."""
    k = (seeded_hash("example_id", "references") % 3 + 1).cast("int")
    options = F.array("outputs", F.replace("outputs", F.lit("a"), F.lit("o")), "inputs")
    return examples(spark, sf_dir).withColumn("outputs", F.slice(options, F.lit(1), k))


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    h = F.col("doc_id") % 10
    return documents.join(labels, "doc_id", "left").withColumn(
        "split", F.when(h < 5, "train").when(h < 8, "test").otherwise("validation")
    )


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    step = F.col("event_id") % 1000
    broken = (F.col("event_type") == "error") & (F.col("value") < 1.0)
    return events.select(
        F.floor(F.col("event_id") / 1000).alias("run_id"),
        F.floor(step / 250).alias("epoch"),
        step.alias("step"),
        (step % 250).alias("step_in_epoch"),
        F.col("ts"),
        "event_type",
        F.when(broken, F.lit(float("nan"))).otherwise(F.col("value")).alias("loss"),
    )


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = seeded_hash("vec_id", "label")
    return table(spark, sf_dir, "embeddings").select(
        F.floor(F.col("vec_id") / SEQUENCE).alias("seq_id"),
        (F.col("vec_id") % SEQUENCE).cast("int").alias("pos"),
        F.col("embedding").alias("logits"),
        F.when(h % 7 == 0, -100).otherwise((h % VOCABULARY).cast("int")).alias("label"),
    )


def sql_hash(key: str, seed: str | int) -> str:
    return f"cast('0x' || substr(md5(cast({key} as varchar) || '|{seed}'), 1, 8) as bigint)"


_H = sql_hash("pair_id", "quality")
_K = f"({sql_hash('pair_id', 'damage')} % 6)"
_E = f"({sql_hash('pair_id', 'empty')} % 5)"

SQL = {
    "pairs": f"""
        pairs0 as (
          select a.conv_id * 100000 + a.turn as pair_id, a.text as src_text, b.text as trg_text, a.role as dataset
          from conversations a join conversations b on a.conv_id = b.conv_id and b.turn = a.turn + 1),
        pairs as (
          select pair_id, src_text, trg_text,
            case when {_H} % 37 <> 0 then ({_H} % 1001)::double / 1000.0::double end as bicleaner_ai_score,
            floor(least(length(src_text), length(trg_text))::double * 1000.0::double
              / nullif(greatest(length(src_text), length(trg_text)), 0)::double) / 1000.0::double as bleualign_score,
            dataset
          from pairs0)""",
    "noisy_pairs": f"""
        noisy_pairs as (
          select pair_id * 4 + copy as pair_id, src_text, case when copy <> 3 then trg_text end as trg_text
          from (select *, unnest(range(0, {sql_hash('pair_id', 'copies')} % 4 + 1)) as copy from pairs))""",
    "extremes": f"""
        extremes as (
          select pair_id, case {sql_hash('pair_id', 'extremes')} % 40 when 0 then 'inf'::double when 1 then '-inf'::double
            when 2 then 'nan'::double else coalesce(bicleaner_ai_score, 0.5::double) end as x
          from pairs)""",
    "examples": f"""
        examples as (
          select 'suite' as experiment, 'r1' as run_id, dataset, pair_id as example_id,
            src_text as inputs, trg_text as outputs,
            case {_K} when 0 then trg_text
              when 1 then replace(trg_text, 'e', 'a')
              when 2 then substr(trg_text, (length(trg_text) // 2) + 1) || ' ' || substr(trg_text, 1, length(trg_text) // 2)
              when 3 then replace(trg_text, 'th', 'd')
              when 4 then substr(trg_text, 1, length(trg_text) // 2)
              else case when {_E} = 0 then '' else replace(trg_text, ' ', '  ') end end as predictions
          from pairs)""",
    "with_references": f"""
        with_references as (
          select * exclude (outputs), list_slice([outputs, replace(outputs, 'a', 'o'), inputs], 1,
            {sql_hash('example_id', 'references')} % 3 + 1) as outputs
          from examples)""",
    "corpus": "corpus as (select doc_id, source, lang, text from documents)",
    "labelled": """
        labelled as (
          select d.doc_id, d.lang, d.source, l.quality as label,
            case when d.doc_id % 10 < 5 then 'train' when d.doc_id % 10 < 8 then 'test' else 'validation' end as split
          from documents d left join labels l on d.doc_id = l.doc_id)""",
    "run_log": """
        run_log as (
          select event_id // 1000 as run_id, (event_id % 1000) // 250 as epoch, event_id % 1000 as step,
            (event_id % 1000) % 250 as step_in_epoch, ts, event_type,
            case when event_type = 'error' and value < 1.0 then 'nan'::double else value end as loss
          from events)""",
    "tokens": f"""
        tokens as (
          select vec_id // {SEQUENCE} as seq_id, (vec_id % {SEQUENCE})::int as pos, embedding as logits,
            case when {sql_hash('vec_id', 'label')} % 7 = 0 then -100
              else ({sql_hash('vec_id', 'label')} % {VOCABULARY})::int end as label
          from embeddings)""",
}

_NEEDS = {"noisy_pairs": ["pairs"], "extremes": ["pairs"], "examples": ["pairs"], "with_references": ["pairs", "examples"]}


def with_fixtures(*names: str) -> str:
    """The ``WITH`` clause, without a trailing comma, that defines the named fixtures."""
    ordered: list[str] = []
    for name in names:
        for part in (*_NEEDS.get(name, []), name):
            if part not in ordered:
                ordered.append(part)
    return "with " + ", ".join(SQL[n].strip() for n in ordered)
