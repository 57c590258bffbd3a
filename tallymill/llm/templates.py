"""Benchmark passages in documents, also when their numbers, names and units were exchanged.

Every text becomes a template: its words in lower case, with typed placeholders for numbers, for
units after a number and for names. Windows of template words are joined by hash with those of the
benchmark, the templates are compared word by word, and the slot values of matching windows must
map consistently: one value of the item to one value of the document. Windows that are mostly
placeholders tell nothing as templates; they are compared by their raw words. Only DataFrame
functions run.

A document's windows are tested inside its row against a bitmap of fixed size that the benchmark's
windows set, so only windows that may match leave the row; the join that follows is exact.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymill.llm.common import leave_out, whole

WINDOW = 8  # words
LEAST_LITERAL = 4  # words of a window that are no placeholder
LEAST_COVERAGE = 0.5  # share of an item's windows
MASK_BITS = 20
BETWEEN = r"\x00\x02-\x2F\x3A-\x40\x5B-\x60\x7B-\xBF\x{2000}-\x{206F}\x{3000}-\x{303F}"  # what separates words
START = "\x01"  # stands before the first word of a sentence
NUMBER, UNIT, NAME = "<num>", "<unit>", "<name>"
UNITS = (
    "mm cm m km in inch inches ft foot feet yd yards mi mile miles mg g kg t lb lbs pound pounds oz ounces ml cl l liter liters "
    "litre litres gal gallons s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years "
    "cent cents dollar dollars euro euros usd eur percent degrees kmh mph w kw v kb mb gb tb"
).split()


def raw_words(text: Column) -> Column:
    """Runs of letters and digits; the first of a sentence begins with `START`."""
    marked = F.regexp_replace(whole(text), rf"(?:[.!?:][{BETWEEN}]*\s|^)[{BETWEEN}]*", f" {START}")
    return F.split(F.trim(F.regexp_replace(marked, f"[{BETWEEN}]+", " ")), " ")


def template(raw: Column) -> Column:
    """The template word of each raw word.

    A name is a word that starts with a capital and goes on in small letters. So is the first word
    of a sentence, whatever its case: there a capital tells nothing, and a copy in other case must
    give the same template.
    """
    digit = lambda x: F.ascii(x).between(48, 57)

    def of(x: Column, i: Column) -> Column:
        capital = F.ascii(x).between(65, 90) | (F.ascii(x) >= 192)
        first, second = F.substring(x, 1, 1), F.substring(x, 2, 1)
        name = capital & (first != F.lower(first)) & (second != "") & (second == F.lower(second))
        unit = F.coalesce(digit(F.ltrim(F.get(raw, i - 1), F.lit(START))), F.lit(False)) & F.lower(x).isin(*UNITS)
        started = F.when(digit(F.substring(x, 2, 1)), NUMBER).otherwise(NAME)
        return F.when(F.ascii(x) == 1, started).when(digit(x), NUMBER).when(unit, UNIT).when(name, NAME).otherwise(F.lower(x))

    return F.transform(raw, of)


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once per row; named twice, it would be computed twice."""
    return F.get(F.transform(F.array(value), body), 0)


def windows(words: Column, width: int, wanted: Callable[[Column], Column] | None = None) -> Column:
    """`at` (from 0) and hash `h` of every window of `width` template words whose hash is `wanted`."""
    last = F.size(words) - width
    hashes = _bound(
        F.transform(words, lambda x: F.xxhash64(x)),
        lambda hashed: F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(hashed, i + k) for k in range(width)])),
    )
    found = lambda h, i: F.struct(i.alias("at"), h.alias("h"))
    each = F.transform(hashes, found if wanted is None else lambda h, i: F.when(wanted(h), found(h, i)))
    return F.when(last >= 0, each if wanted is None else F.array_compact(each)).otherwise(F.array().cast("array<struct<at:int,h:bigint>>"))


def _places(h: Column) -> list[Column]:
    return [F.shiftrightunsigned(h, 64 - MASK_BITS).cast("int"), h.bitwiseAND((1 << MASK_BITS) - 1).cast("int")]


def _mask(hashes: DataFrame) -> Column:
    """2^20 bits, two of them set for every hash, as a literal of 64-bit words."""
    places = reduce(DataFrame.unionByName, [hashes.select(p.alias("p")) for p in _places(F.col("h"))])
    words = places.groupBy(F.shiftright("p", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, p & 63))").alias("bits"))
    bits = dict.fromkeys(range(1 << (MASK_BITS - 6)), 0) | {r["word"]: r["bits"] for r in words.collect()}  # 16,384 words at most
    return F.split(F.lit(",".join(str(bits[i]) for i in sorted(bits))), ",").cast("array<bigint>")


def _in_mask(mask: Column, h: Column) -> Column:
    tests = [F.getbit(F.get(mask, F.shiftright(p, 6)), p.bitwiseAND(63)) == 1 for p in _places(h)]
    return reduce(Column.__and__, tests)


def _prepared(table: DataFrame, id_col: str, text_col: str, name: str) -> DataFrame:
    """Id, raw words and template; words are cut out once per row."""
    rows = table.select(F.col(id_col).alias(name), raw_words(F.col(text_col)).alias("raw"))
    return rows.select(name, "raw", template(F.col("raw")).alias("words"))


def find(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", coverage: float = LEAST_COVERAGE) -> DataFrame:
    """One row per document and item it gives away: `doc_id`, `item_id`, `n_windows`, `matched`, `coverage`, `kind`.

    Windows with four words that are no placeholder are looked for as templates, the others by their
    raw words in any case. `n_windows` counts the item's windows, `matched` those found in the
    document in an alignment and in agreement with it (see `_agreeing`); where the templates alone are found in a larger share, both
    count the windows looked for as templates. A row needs the share `coverage`. `kind` is "copy" if
    every slot of the windows found has the item's own value in some alignment, else "slots". An item shorter than a
    window is one window; one with fewer than four words cannot be found, and one with fewer than
    four that are no placeholder in any window only as it stands. Null and empty texts match
    nothing; rows that repeat a doc_id count as one document.
    """
    items = _prepared(benchmark, item_col, item_text_col, "item_id")
    short = items.select(F.least(F.lit(WINDOW), F.size("raw")).alias("w")).where(F.col("w") >= LEAST_LITERAL).distinct()
    widths = sorted(r["w"] for r in short.collect())  # from 4 to 8
    wanted = []
    for width in widths:
        fits = items.where(F.least(F.lit(WINDOW), F.size("raw")) == width)
        cut = lambda c: F.slice(c, F.col("w.at") + 1, F.lit(width))  # noqa: B023, E731
        exploded = fits.select("item_id", "raw", "words", F.explode(windows(F.col("words"), width)).alias("w"))
        parts = exploded.select("item_id", F.col("w.at").alias("item_at"), F.col("w.h").alias("h"), F.lit(width).alias("width"), cut("raw").alias("item_raw"), cut("words").alias("template"), F.transform(cut("raw"), _value).alias("said"))
        said = F.xxhash64(*[F.xxhash64(F.get("said", F.lit(k))) for k in range(width)])
        wanted.append(
            parts.withColumn("exact", F.size(F.filter("template", lambda x: ~x.isin(NUMBER, UNIT, NAME))) < LEAST_LITERAL)
            .withColumn("h", F.when(F.col("exact"), said).otherwise(F.col("h")))
            .withColumn("key", F.when(F.col("exact"), F.col("said")).otherwise(F.col("template")))
            .drop("said")
        )
    if not wanted:
        return _empty(docs, benchmark, id_col, item_col)
    wanted = reduce(DataFrame.unionByName, wanted)
    exact = {r["width"] for r in wanted.where("exact").select("width").distinct().collect()}  # widths with windows to compare by raw words
    ends = [wanted.where("exact").select(F.xxhash64(F.get("key", k)).alias("h")) for k in (F.lit(0), F.col("width") - 1)]
    mask = _mask(reduce(DataFrame.unionByName, [wanted.select("h"), *ends]))
    totals = wanted.groupBy("item_id").agg(F.count_distinct("item_at").alias("n_all"), F.count_distinct(F.when(~F.col("exact"), F.col("item_at"))).alias("n_templates"))

    rows = _prepared(docs, id_col, text_col, "doc_id")
    # bound, the mask stands in the plan once
    cut = _bound(mask, lambda m: F.concat(*[_candidates(m, width, by) for width in widths for by in (False, True) if not by or width in exact]))
    met = rows.select("doc_id", F.explode(cut).alias("w")).select("doc_id", "w.*")
    same = ["h", "width", "exact", "key"]
    pairs = met.join(wanted.join(_plain_starts(items), "item_id", "left"), same).select("doc_id", "item_id", (F.col("at") - F.col("item_at")).alias("shift"), F.struct("item_at", "exact", _slots().alias("slots")).alias("w"))
    # one alignment of a document and an item: which of its windows agree?
    aligned = pairs.groupBy("doc_id", "item_id", "shift").agg(F.collect_set("w").alias("ws")).select("doc_id", "item_id", _agreeing(F.col("ws")).alias("ws")).where(F.size("ws") > 0)
    aligned = aligned.select(
        "doc_id", "item_id", F.transform("ws", lambda w: w["item_at"]).alias("ats"), F.transform(F.filter("ws", lambda w: ~w["exact"]), lambda w: w["item_at"]).alias("template_ats"),
        F.forall("ws", _verbatim).alias("copied"),
    )
    places = lambda c: F.size(F.array_distinct(F.flatten(F.collect_list(c))))
    found = (
        aligned
        .groupBy("doc_id", "item_id")
        .agg(places("ats").alias("all"), places("template_ats").alias("templates"), F.max("copied").alias("copied"))
        .join(totals.withColumnRenamed("item_id", "__item"), F.col("item_id").eqNullSafe(F.col("__item")))
    )
    # only templates are found with other values in the slots
    by_template = F.col("templates") * F.col("n_all") > F.col("all") * F.col("n_templates")
    return (
        found.withColumn("n_windows", F.when(by_template, F.col("n_templates")).otherwise(F.col("n_all")).cast("int"))
        .withColumn("matched", F.when(by_template, F.col("templates")).otherwise(F.col("all")))
        .withColumn("coverage", F.col("matched") / F.col("n_windows"))
        .where(F.col("coverage") >= coverage)
        .select("doc_id", "item_id", "n_windows", "matched", "coverage", F.when(F.col("copied"), "copy").otherwise("slots").alias("kind"))
    )


def _candidates(mask: Column, width: int, exact: bool) -> Column:
    """A document's windows of template words, or raw words if `exact`, that the mask lets through."""
    part = lambda array, w: F.slice(F.col(array), w["at"] + 1, F.lit(width))
    found = _said(mask, width) if exact else windows(F.col("words"), width, lambda h: _in_mask(mask, h))
    key = lambda w: F.transform(part("raw", w), _value) if exact else part("words", w)
    return F.transform(found, lambda w: F.struct(w["at"].alias("at"), w["h"].alias("h"), F.lit(width).alias("width"), F.lit(exact).alias("exact"), part("raw", w).alias("raw"), key(w).alias("key")))


def _said(mask: Column, width: int) -> Column:
    """Windows of raw words that the mask lets through; those whose first and last word it holds are hashed."""
    last = F.size("raw") - width
    hashes = _bound(
        F.transform("raw", lambda x: F.xxhash64(_value(x))),
        lambda hashed: F.transform(
            F.filter(F.sequence(F.lit(0), last), lambda i: _in_mask(mask, F.get(hashed, i)) & _in_mask(mask, F.get(hashed, i + width - 1))),
            lambda i: F.struct(i.alias("at"), F.xxhash64(*[F.get(hashed, i + k) for k in range(width)]).alias("h")),
        ),
    )
    return F.when(last >= 0, F.filter(hashes, lambda w: _in_mask(mask, w["h"]))).otherwise(F.array().cast("array<struct<at:int,h:bigint>>"))


def _value(x: Column) -> Column:
    """A raw word in lower case, wherever it stands in its sentence."""
    return F.lower(F.ltrim(x, F.lit(START)))


def _slots() -> Column:
    """Values of the item and the document in the placeholders of a window, and their places in the item.

    `free` slots, plain words that open a sentence of the item, may have any value.
    """
    at = F.transform("template", lambda x, k: F.col("item_at") + k)
    zipped = F.arrays_zip(F.col("template").alias("kind"), F.col("item_raw").alias("item"), F.col("raw").alias("doc"), at.alias("at"))
    slots = F.filter(zipped, lambda z: z["kind"].isin(NUMBER, UNIT, NAME))
    free = lambda z: F.coalesce((z["kind"] == NAME) & (F.ascii(z["item"]) == 1) & F.array_contains("plain", _value(z["item"])), F.lit(False))
    return F.transform(slots, lambda z: F.struct(z["at"].alias("at"), F.concat(z["kind"], _value(z["item"])).alias("item"), F.concat(z["kind"], _value(z["doc"])).alias("doc"), free(z).alias("free")))


def _plain_starts(items: DataFrame) -> DataFrame:
    """`plain`: the words that open a sentence of an item and are no names, as the benchmark has them in small letters elsewhere."""
    small = items.select(F.explode("words").alias("word")).where(~F.col("word").isin(NUMBER, UNIT, NAME)).distinct()
    starts = items.select("item_id", F.explode(F.filter("raw", lambda x: F.ascii(x) == 1)).alias("x")).select("item_id", _value(F.col("x")).alias("word"))
    return starts.join(small, "word").groupBy("item_id").agg(F.collect_set("word").alias("plain"))


def _verbatim(w: Column) -> Column:
    return ~F.exists(w["slots"], lambda s: s["item"] != s["doc"])


def _agreeing(ws: Column) -> Column:
    """The windows of an alignment whose slots map consistently.

    Windows that match word for word always count. The others must have the value of the document
    that a slot's value has at most places, or its own if as many places have that. A value with no
    such majority stands for two of the document's: its windows do not count, and none but those word
    for word do if over half of the values at several places are of that kind.
    """
    votes = F.array_distinct(F.flatten(F.transform(ws, lambda w: F.transform(F.filter(w["slots"], lambda s: ~s["free"]), lambda s: s.dropFields("free")))))

    def winner(votes: Column, item: Column) -> Column:
        mine = lambda f: F.transform(F.filter(votes, lambda v: v["item"] == item), f)
        count = lambda docs, d: F.size(F.filter(docs, lambda x: x == d))
        ranked = _bound(mine(lambda v: v["doc"]), lambda docs: F.sort_array(F.transform(F.array_distinct(docs), lambda d: F.struct(count(docs, d).alias("n"), (d == item).alias("own"), d.alias("doc"))), asc=False))
        tie = lambda r: (F.get(r, 0)["n"] == F.get(r, 1)["n"]) & ~F.get(r, 0)["own"]
        return F.struct(item.alias("item"), _bound(ranked, lambda r: F.when(tie(r), None).otherwise(F.get(r, 0)["doc"])).alias("doc"))

    pairs = lambda v: F.array_distinct(F.transform(v, lambda s: F.concat(s["item"], F.lit(START), s["doc"])))
    names = lambda v: F.array_distinct(F.transform(v, lambda s: s["item"]))
    several = lambda v, name: F.size(F.array_distinct(F.transform(F.filter(v, lambda s: s["item"] == name), lambda s: s["at"]))) > 1
    split = lambda v, name: F.size(F.array_distinct(F.transform(F.filter(v, lambda s: s["item"] == name), lambda s: s["doc"]))) > 1

    def counted(v: Column, winners: Column) -> Column:
        open_values = F.size(F.filter(winners, lambda x: x["doc"].isNull()))
        lost = 2 * open_values > F.size(F.filter(names(v), lambda n: several(v, n)))
        differs = lambda s, x: ~s["free"] & (s["item"] == x["item"]) & ~s["doc"].eqNullSafe(x["doc"])
        agrees = lambda w: ~F.exists(w["slots"], lambda s: F.exists(winners, lambda x: differs(s, x)))
        return _bound(lost, lambda lost: F.filter(ws, lambda w: _verbatim(w) | (~lost & agrees(w))))

    resolved = lambda v: F.transform(F.filter(names(v), lambda n: split(v, n)), lambda n: winner(v, n))
    return _bound(votes, lambda v: F.when(F.size(pairs(v)) == F.size(names(v)), ws).otherwise(_bound(resolved(v), lambda winners: counted(v, winners))))


def _empty(docs: DataFrame, benchmark: DataFrame, id_col: str, item_col: str) -> DataFrame:
    """No item long enough to look for: no rows, the usual columns."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.lit(None).cast(benchmark.schema[item_col].dataType).alias("item_id")).limit(0)
    return rows.select("doc_id", "item_id", F.lit(0).alias("n_windows"), F.lit(0).alias("matched"), F.lit(0.0).alias("coverage"), F.lit("").alias("kind"))


def remove(docs: DataFrame, findings: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """`docs` without the documents of `findings`."""
    return leave_out(docs, id_col, findings, "doc_id")
