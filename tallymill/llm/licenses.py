"""Licence detection by ordered signature rules.

A text becomes its lower-case words with single blanks between them. Keywords say which rules can
match at all; only those regexes run. Every match is a span of words. A span that lies within one of
equal or higher priority is suppressed, the earlier rule going first where spans agree. Only
DataFrame functions run; spans of one text meet in a window ordered by place, with one running
maximum per priority, so a text with very many matches costs a sort and nothing quadratic.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallymill.llm.common import ascii_lower, whole
from tallymill.llm.license_rules import RULES, Rule

BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # what separates words, after lower-casing
OPEN, CLOSE = "\x02", "\x03"
WEIGHTS = {1: 1.0, 2: 0.9, 3: 0.7, 4: 0.4}  # score of a surviving span by its rule's priority


def words_of(text: Column) -> Column:
    """The words of a text with single blanks between them."""
    return F.trim(F.regexp_replace(ascii_lower(whole(text)), BETWEEN, " "))


def _table(rules: Sequence[Rule]) -> Column:
    """The rules by keyword, as one literal: array of (keyword, array of rules)."""
    by_keyword: dict[str, list[dict]] = {}
    for number, r in enumerate(rules):
        rule = {"rule": number, "priority": r.priority, "base": r.base, "pattern": f"(?<![^ ])(?:{r.regex})(?![^ ])"}
        by_keyword.setdefault(r.keyword, []).append(rule)
    listed = json.dumps([{"keyword": k, "rules": v} for k, v in by_keyword.items()])
    return F.from_json(F.lit(listed), "array<struct<keyword:string,rules:array<struct<rule:int,priority:int,base:boolean,pattern:string>>>>")


def spans(words: Column, rule: Column) -> Column:
    """Places of a rule's matches, as first and last word; the marks around a match become those of its words."""
    tokens = F.split(F.regexp_replace(words, rule["pattern"], F.lit(f"{OPEN}$0{CLOSE}")), " ")
    place = lambda t, i: F.struct(i.alias("i"), F.startswith(t, F.lit(OPEN)).alias("a"), F.endswith(t, F.lit(CLOSE)).alias("z"))
    marked = F.filter(F.transform(tokens, place), lambda m: m["a"] | m["z"])
    starts = F.transform(F.filter(marked, lambda m: m["a"]), lambda m: m["i"])
    ends = F.transform(F.filter(marked, lambda m: m["z"]), lambda m: m["i"])
    return F.zip_with(starts, ends, lambda a, z: F.struct(rule["rule"].alias("rule"), rule["priority"].alias("priority"), rule["base"].alias("base"), a.alias("start"), z.alias("end")))


def _found(words: Column, table: Column) -> Column:
    """All spans of a text; a rule whose keyword is missing is not asked."""
    asked = F.flatten(F.transform(F.filter(table, lambda g: F.contains(words, g["keyword"])), lambda g: g["rules"]))
    matching = F.filter(asked, lambda r: F.rlike(words, r["pattern"]))
    return F.flatten(F.transform(matching, lambda r: spans(words, r)))


def scan(docs: DataFrame, carry: Sequence[str] = ("doc_id",), text_col: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """The `carry` columns of every row, with what was found in its text.

    `n_words`; `n_base`, `first_word`, `last_word` (places of the base phrases, words from 0, null if
    there are none); `base_labels` and `labels` (distinct, sorted, joined by commas; empty if none);
    `score` (0 to 1, that of the strongest surviving span); `spans` (rule, label, start, end of what
    survives, by place). Base phrases are never suppressed. Null and empty texts have no words. A
    carried column with the name of a result is replaced. One row comes out for each row, repeated
    ids included.
    """
    results = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
    carry = [c for c in carry if c not in results]
    n_words = F.when(F.col("__words") == "", 0).otherwise(F.length("__words") - F.length(F.replace(F.col("__words"), F.lit(" "), F.lit(""))) + 1)
    rows = docs.select(F.struct(*[F.col(c) for c in carry]).alias("__row"), words_of(F.col(text_col)).alias("__words"))
    rows = rows.select("__row", n_words.cast("long").alias("n_words"), _found(F.col("__words"), _table(rules)).alias("found"), F.monotonically_increasing_id().alias("n"))
    each = rows.select("__row", "n_words", "n", F.explode_outer("found").alias("s")).select("__row", "n_words", "n", "s.*")
    before = Window.partitionBy("n").orderBy("start", F.desc("end"), "priority", "rule").rowsBetween(Window.unboundedPreceding, -1)
    levels = sorted({r.priority for r in rules})
    # the farthest end so far of spans of this priority or a higher one
    covered = F.greatest(F.lit(-1), F.lit(-1), *[F.when(F.col("priority") >= p, F.max(F.when(F.col("priority") == p, F.col("end"))).over(before)) for p in levels])
    labels = F.array(*[F.lit(r.label) for r in rules])
    each = each.withColumn("kept", F.col("rule").isNotNull() & (covered < F.col("end"))).withColumn("label", F.get(labels, F.col("rule")))
    joined = lambda which: F.array_join(F.array_sort(F.collect_set(F.when(which, F.col("label")))), ",")
    weight = F.element_at(F.create_map(*[F.lit(x) for pair in WEIGHTS.items() for x in pair]), F.col("priority"))
    base = F.coalesce("base", F.lit(False))
    place = F.struct("start", "end", "rule", "label")
    out = each.groupBy("n").agg(
        F.first("__row").alias("__row"),
        F.first("n_words").alias("n_words"),
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
        joined(base).alias("base_labels"),
        joined(base | F.col("kept")).alias("labels"),
        F.coalesce(F.max(F.when(base | F.col("kept"), weight)), F.lit(0.0)).alias("score"),
        F.array_sort(F.collect_list(F.when(F.col("kept"), place))).alias("spans"),
    )
    return out.select("__row.*", *results)
