"""Licence scan: ordered signature rules, keyword gate, suppression of contained detections.

Texts become word strings. Rules are filed by keyword; a text runs only the expressions filed under the
keywords it contains, and a text with none of the keywords runs none. Detections then compete: one that
lies inside another of the same or a higher priority is suppressed (of equal intervals the higher priority,
then the earlier rule stays). Containment is decided in one sweep over the detections of a text sorted by
start, which keeps the furthest end seen per priority; nothing is compared in pairs.

The operator works row by row and shuffles nothing, so a hot licence line cannot skew it.

Defined results: NULL and empty texts have no words and no detections; repeated rows give repeated results;
an empty table gives no rows. Texts are read whole, in time linear in their words and detections.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataload.llm.license_rules import BASE, Signature, signatures
from strataload.llm.tables import all_gathered, gathered, lower_ascii, match_spans, nothing_gathered, texts

SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
PRIORITIES = 4
STEMS = "licen clause commons copy gnu bsd software proprietary permission".split() + ["cc by", "public domain"]
RULES = (
    "array<struct<keyword:string,rules:array<struct<rule:int,label:string,priority:int,weight:double,regex:string>>>>"
)
DETECTIONS = "array<struct<start:int,back:int,down:int,rule:int,end:int,label:string,priority:int,weight:double>>"


def _rule_groups(rules: list[Signature]) -> Column:
    """The rules as one constant: array of (keyword, array of rules)."""
    by_keyword: dict[str, list[dict]] = {}
    for number, rule in enumerate(rules):
        by_keyword.setdefault(rule.keyword, []).append(
            {"rule": number, "label": rule.label, "priority": rule.priority, "weight": rule.weight, "regex": rule.regex}
        )
    constant = json.dumps([{"keyword": key, "rules": found} for key, found in by_keyword.items()])
    return F.from_json(F.lit(constant), RULES)


def _detections(words: Column, rules: list[Signature]) -> Column:
    groups = F.filter(_rule_groups(rules), lambda g: F.contains(words, g["keyword"]))
    candidates = F.flatten(F.transform(groups, lambda g: g["rules"]))

    def run(rule):
        return F.transform(
            match_spans(words, rule["regex"]),
            lambda m: F.struct(
                m["start"].alias("start"),
                (-m["end"]).alias("back"),
                (-rule["priority"]).alias("down"),
                rule["rule"].alias("rule"),
                m["end"].alias("end"),
                rule["label"].alias("label"),
                rule["priority"].alias("priority"),
                rule["weight"].alias("weight"),
            ),
        )

    return F.array_sort(F.flatten(F.transform(candidates, run)))


def _unsuppressed(found: Column) -> Column:
    """Those not contained in a detection of the same or a higher priority; ``found`` is sorted."""

    def step(state, d):
        inside = F.lit(False)
        for level in range(1, PRIORITIES + 1):
            inside = inside | ((d["priority"] <= level) & (state[f"end{level}"] >= d["end"]))
        ends = [
            F.when(d["priority"] == level, F.greatest(state[f"end{level}"], d["end"]))
            .otherwise(state[f"end{level}"])
            .alias(f"end{level}")
            for level in range(1, PRIORITIES + 1)
        ]
        return F.struct(*ends, *gathered(state, d, ~inside, DETECTIONS))

    start = F.struct(
        *(F.lit(-1).alias(f"end{level}") for level in range(1, PRIORITIES + 1)), *nothing_gathered(DETECTIONS)
    )
    return F.aggregate(found, start, step, all_gathered)


def gate_stems(rules: list[Signature]) -> list[str]:
    """A few strings of which every keyword contains one; a text without any of them is not looked at again."""
    keywords = {rule.keyword for rule in rules}
    stems = {stem for stem in STEMS if any(stem in keyword for keyword in keywords)}
    return sorted(stems | {keyword for keyword in keywords if not any(stem in keyword for stem in stems)})


def detect(docs: DataFrame, rules: list[Signature] | None = None) -> DataFrame:
    """(doc_id, words, found, kept): the word string of a text, all detections and those that stand.

    Offsets are in the word string, which begins and ends with a space.
    """
    rules = signatures() if rules is None else rules
    words = F.trim(F.regexp_replace("text", SEPARATORS, " "))
    rows = texts(docs).select("doc_id", F.concat(F.lit(" "), words, F.lit(" ")).alias("words"))
    gate = F.lit(False)
    lowered = F.lower("words")
    for stem in gate_stems(rules):
        gate = gate | F.contains(lowered, F.lit(stem))
    rows = rows.withColumn("gate", gate)
    none = F.array().cast(DETECTIONS)
    rows = rows.withColumn("lowered", F.when(F.col("gate"), lower_ascii(F.col("words"))))
    rows = rows.withColumn("found", F.when(F.col("gate"), _detections(F.col("lowered"), rules)).otherwise(none))
    return rows.withColumn("kept", F.when(F.size("found") == 0, none).otherwise(_unsuppressed(F.col("found"))))


def scan_licenses(docs: DataFrame) -> DataFrame:
    """Every document with its base phrases, their word places, and the labels that stand."""

    def spaces(value: Column) -> Column:
        return F.length(value) - F.length(F.replace(value, F.lit(" "), F.lit("")))

    def word_at(start: Column) -> Column:
        return (spaces(F.left("words", start)) - 1).cast("long")

    base = F.filter("found", lambda d: d["rule"] < len(BASE))
    rows = detect(docs).withColumn("base", base)
    labels = F.array_distinct(F.transform("base", lambda d: d["label"]))
    own = F.transform("kept", lambda d: d["label"])
    some = F.size("base") > 0
    return rows.select(
        "doc_id",
        F.when(F.col("words") == "  ", 0).otherwise(spaces(F.col("words")) - 1).cast("long").alias("n_words"),
        F.size("base").cast("long").alias("n_base"),
        F.when(some, word_at(F.array_min(F.transform("base", lambda d: d["start"])))).alias("first_word"),
        F.when(some, word_at(F.array_max(F.transform("base", lambda d: d["start"])))).alias("last_word"),
        F.array_join(F.array_sort(labels), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(labels, own)), ",").alias("labels"),
        F.coalesce(F.array_max(F.transform("kept", lambda d: d["weight"])), F.lit(0.0)).alias("score"),
        F.size("kept").cast("long").alias("n_kept"),
    )
