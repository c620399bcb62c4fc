"""Licence scan with ordered signature rules, in DataFrame functions alone.

A search for the rules' keywords in the text in lower case gates the rows; most texts end there. A gated text becomes its words
in lower case with one blank between them. Each rule whose keyword occurs gives the intervals of its matches. Intervals
are swept from left to right, and one that lies inside an accepted interval of the same or an earlier priority is
suppressed.
"""

from __future__ import annotations

import json
from dataclasses import asdict
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bitexture.llm.common import ascii_lower
from bitexture.llm.license_rules import Rule, signature_rules

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # of lower-cased text
ANY_CASE_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
RULE_TYPE = "array<struct<priority:int,label:string,keyword:string,pattern:string,weight:double>>"
BASE_WEIGHT = 0.8

# Phrases that always count, and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


def bounded(words: str) -> str:
    """A pattern over whole words of a normalised text."""
    return f"(?<= )(?:{words})(?= )"


def rule_array(rules: list[Rule]) -> Column:
    """The rules as one constant."""
    rows = [asdict(rule) | {"pattern": bounded(rule.pattern)} for rule in rules]
    return F.from_json(F.lit(json.dumps(rows)), RULE_TYPE)


def gate(low: Column, rules: list[Rule]) -> Column:
    """Whether any keyword of a rule or base phrase occurs in a text in lower case.

    Letters that only become a-z in lower case let a few more texts through; the rules read those like any other.
    """
    keywords = sorted({rule.keyword for rule in rules} | {"license"})
    shortest = [k for k in keywords if not any(o != k and o in k for o in keywords)]
    return reduce(lambda a, b: a | b, [F.contains(low, F.lit(k)) for k in shortest])


def normalised(text: Column) -> Column:
    """Words in lower case, a blank before, between and after them."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(ascii_lower(text), NOT_WORD, " ")), F.lit(" "))


def blanks(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _with_base(df: DataFrame) -> DataFrame:
    """Places of the base phrases in ``norm``, which is missing in rows without a keyword."""
    for i, phrase in enumerate(BASE):
        df = df.withColumn(f"parts{i}", F.split("norm", bounded(phrase), -1))
    counts, firsts, lasts = [], [], []
    for i, phrase in enumerate(BASE):
        parts = F.col(f"parts{i}")
        hits = F.size(parts) - 1
        counts.append(F.when(hits > 0, hits).otherwise(0))
        after = blanks(F.element_at(parts, -1)) - 1
        firsts.append(F.when(hits > 0, blanks(parts[0]) - 1))
        lasts.append(F.when(hits > 0, F.col("n_words") - after - len(phrase.split())))
    labels = [F.when(n > 0, F.lit(label)) for n, label in zip(counts, BASE.values())]
    return df.select(
        "*",
        sum(counts[1:], counts[0]).cast("long").alias("n_base"),
        F.least(*firsts).cast("long").alias("first_word"),
        F.greatest(*lasts).cast("long").alias("last_word"),
        F.array_sort(F.array_compact(F.array(*labels))).alias("base"),
    )


def _intervals(hit: Column) -> Column:
    """The matches of one rule as intervals, from the pieces between them and the matches themselves."""
    none = F.struct(F.length(hit["parts"][0]).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("all"))

    def step(acc, i):
        end = acc["at"] + F.length(F.get(hit["matches"], i))
        one = F.array(F.struct(acc["at"].alias("start"), end.alias("end")))
        return F.struct((end + F.length(F.get(hit["parts"], i + 1))).alias("at"), F.concat(acc["all"], one).alias("all"))

    return F.aggregate(F.sequence(F.lit(0), F.size(hit["matches"]) - 1), none, step, lambda acc: acc["all"])


def _accepted(found: str) -> Column:
    """Sweep over detections sorted by start, longest first: what no accepted, earlier rule encloses."""
    kind = "array<struct<start:int,reach:int,priority:int,label:string,weight:double,end:int>>"
    none = F.struct(F.array().cast(kind).alias("kept"), F.array().cast(kind).alias("open"))

    def step(acc, d):
        still = F.filter(acc["open"], lambda o: o["end"] > d["start"])
        inside = F.exists(acc["open"], lambda o: (o["end"] >= d["end"]) & (o["priority"] <= d["priority"]))
        one = F.array(d)
        return F.struct(
            F.when(inside, acc["kept"]).otherwise(F.concat(acc["kept"], one)).alias("kept"),
            F.when(inside, still).otherwise(F.concat(still, one)).alias("open"),
        )

    return F.aggregate(found, none, step, lambda acc: acc["kept"])


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: list[Rule] | None = None) -> DataFrame:
    """One row per input row with what is found in its whole text.

    Columns: id, ``n_words``; ``n_base``, ``first_word``, ``last_word`` and ``base_labels`` of the base phrases (word
    numbers from 0, missing if there is none); ``labels`` of base and rules, both sorted and joined by commas; ``score``
    from 0 to 1, the weight of the surest detection; ``detections``, the accepted ones with label, rule priority and
    the interval of characters in the normalised text.

    A missing text counts as empty and finds nothing. Of rules that match one place the first wins; a match inside an
    accepted match of the same or an earlier priority is suppressed, one that overlaps it partly or encloses it stays. Base labels
    always stay. Rows are independent, so repeated rows, missing ids and other columns change nothing.
    """
    rules = signature_rules() if rules is None else rules
    df = docs.select(F.col(id_col).alias("doc"), F.coalesce(text_col, F.lit("")).alias("text"))
    df = df.withColumn("low", F.lower("text"))
    df = df.select(
        "doc",
        F.regexp_count("text", F.lit(ANY_CASE_WORD)).cast("long").alias("n_words"),
        F.when(gate(F.col("low"), rules), normalised(F.col("text"))).alias("norm"),
    )
    df = _with_base(df)
    near = F.filter(rule_array(rules), lambda r: F.contains(F.col("norm"), r["keyword"]))
    hits = F.transform(
        near,
        lambda r: F.struct(
            r["priority"].alias("priority"),
            r["label"].alias("label"),
            r["weight"].alias("weight"),
            F.regexp_extract_all("norm", r["pattern"], F.lit(0)).alias("matches"),
            F.split("norm", r["pattern"], F.lit(-1)).alias("parts"),
        ),
    )
    df = df.withColumn("hits", F.when(F.col("norm").isNotNull(), hits))
    df = df.withColumn("hits", F.filter("hits", lambda h: F.size(h["matches"]) > 0))
    each = F.transform(
        "hits",
        lambda h: F.transform(
            _intervals(h),
            lambda x: F.struct(
                x["start"].alias("start"),
                (-x["end"]).alias("reach"),
                h["priority"].alias("priority"),
                h["label"].alias("label"),
                h["weight"].alias("weight"),
                x["end"].alias("end"),
            ),
        ),
    )
    df = df.withColumn("found", F.sort_array(F.flatten(each))).withColumn("kept", _accepted("found"))
    none = F.array().cast("array<string>")
    df = df.withColumn("names", F.coalesce(F.transform("kept", lambda d: d["label"]), none))
    surest = F.coalesce(F.array_max(F.transform("kept", lambda d: d["weight"])), F.lit(0.0))
    return df.select(
        F.col("doc").alias(id_col),
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join(F.coalesce("base", none), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(F.coalesce("base", none), "names")), ",").alias("labels"),
        F.greatest(surest, F.when(F.col("n_base") > 0, BASE_WEIGHT).otherwise(0.0)).alias("score"),
        F.coalesce(
            F.transform(
                "kept",
                lambda d: F.struct(
                    d["label"].alias("label"), d["priority"].alias("priority"), d["start"].alias("start"), d["end"].alias("end")
                ),
            ),
            F.array().cast("array<struct<label:string,priority:int,start:int,end:int>>"),
        ).alias("detections"),
    )
