"""Benchmark decontamination by template windows (DataFrame functions only).

1. Texts become templates: words in lower case without punctuation, in which
   numbers, names (capitalised within a sentence) and units are replaced by
   typed placeholders. A second template leaves names as words, so that a copy
   in lower case matches too.
2. Hashes of the windows of the benchmark's template words are joined with those
   of the documents, so a question with other numbers or names still matches.
   Windows have WINDOW words, those of items of up to 2 * WINDOW words have
   fewer (at least MIN_WINDOW), so that some remain beside one changed word. At
   least half of a window's words must be literal: placeholders alone say nothing.
3. Matches of one document and item that lie on one diagonal (same shift
   between item and document) form an alignment. Its slots are the pairs of
   placeholder values, in lower case. A value of the item stands for the value
   of the document that it meets most often (among equals, for itself); two
   values of the item may stand for one of the document, but one that more
   than MERGED values would stand for tells nothing. Windows that hold a slot
   against this are dropped, the others stay.
4. An item is found in a document if the windows that stay cover COVERAGE of the
   item's literal words and MIN_WORDS words at least, or a run of RUN words in one
   alignment, whatever its share. A changed word in the middle of an item of 4 to
   6 words may leave too few words.
5. An item whose literal windows could not reach that (one of numbers, say) is
   found by its windows of words as they are, with their values, all of which
   count as literal; one of fewer than MIN_WORDS words where it is the whole text.

The join is a broadcast join while the benchmark has at most BROADCAST_WINDOWS
windows, a shuffled one beyond that; only the windows' hashes and places take
part in it. A document is known by its id and text: repeated rows share their
result. Null and empty texts hold and match nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.words import unused
from shelfspark.session import written

WINDOW, MIN_WINDOW, MIN_WORDS, COVERAGE, RUN, MERGED = 8, 3, 4, 0.5, 13, 2
BROADCAST_WINDOWS = 500_000
#: Fixed list of unit words; they count as units next to nothing else.
UNITS = ["mm", "cm", "km", "kg", "mg", "ml", "lb", "lbs", "oz", "ft", "inch", "inches", "mile", "miles", "meter", "meters",
         "metre", "metres", "gram", "grams", "litre", "litres", "liter", "liters", "second", "seconds", "minute", "minutes",
         "hour", "hours", "day", "days", "week", "weeks", "month", "months", "year", "years", "dollar", "dollars", "euro",
         "euros", "cent", "cents", "percent", "usd", "eur", "kmh", "mph"]
_NAME, _NUM, _UNIT = "\u0001", "\u0002num", "\u0002unit"


def with_words(df: DataFrame) -> DataFrame:
    """Adds ``words`` of ``text``: without punctuation, names marked by a leading \\u0001."""
    marked = F.regexp_replace(F.coalesce("text", F.lit("")), "([\\p{Ll},]\\s+)(?=\\p{Lu}\\p{Ll})", f"$1{_NAME}")
    clean = F.btrim(F.regexp_replace(marked, "[^\\p{L}\\p{N}\\s\u0001]+", ""), F.lit(" \t\n\x0b\x0c\r"))
    df = df.withColumn("_clean", clean)
    return df.withColumn("words", F.when(F.col("_clean") == "", F.array().cast("array<string>"))
                         .otherwise(F.split("_clean", "\\s+", -1))).drop("_clean")


def canonical(word: Column) -> Column:
    return (F.when(word.startswith(_NAME), F.lit(_NAME)).when(word.rlike("[0-9]"), F.lit(_NUM))
            .when(F.lower(word).isin(UNITS), F.lit(_UNIT)).otherwise(F.lower(word)))


def is_slot(word: Column) -> Column:
    return word.startswith(_NAME) | word.rlike("[0-9]") | F.lower(word).isin(UNITS)


def _shift(name: str, k: int) -> Column:
    """Array ``name`` without its first ``k`` entries."""
    return F.slice(name, k + 1, F.size(name)) if k else F.col(name)


def _templates(df: DataFrame, exact: bool) -> DataFrame:
    """Adds ``words`` of (.., text) and the hashes of the words of each template:
    ``t`` (all placeholders), ``p`` (names are words), with ``exact`` ``e`` (values, too)."""
    df = with_words(df)
    df = df.withColumn("t", F.transform("words", lambda w: F.xxhash64(canonical(w))))
    df = df.withColumn("p", F.zip_with("words", "t", lambda w, h: F.when(
        w.startswith(_NAME), F.xxhash64(canonical(F.translate(w, _NAME, "")))).otherwise(h)))
    if exact:
        df = df.withColumn("e", F.transform("words", lambda w: F.xxhash64(F.lower(F.translate(w, _NAME, "")))))
    return df


def _whole(words: Column) -> Column:
    """The hash of a text of fewer than MIN_WORDS words."""
    return F.when(F.size(words) < MIN_WORDS, F.xxhash64(F.lit(0), F.array_join(
        F.transform(words, lambda w: F.lower(F.translate(w, _NAME, ""))), " ")))


def _windows(df: DataFrame, sizes: list[int], exact_sizes: list[int], *keep: str) -> DataFrame:
    """``keep``, at, kind, w, window: a row for each place and window size. The size
    is part of the hash, negative for words with their values; a window without
    names has one hash for both templates. A short text has one window, itself.

    Neighbouring words stand side by side in one row per place, so the hashes are
    plain generated code, not lambdas over arrays.
    """
    most = max([*sizes, *exact_sizes, 1])
    kinds = ["t", "p"] + (["e"] if exact_sizes else [])
    whole = df.withColumn("_whole", _whole(F.col("words")))
    beside = whole.select(*keep, "_whole", *[_shift(c, k).alias(f"{c}{k}") for c in kinds for k in range(most)])
    place = F.posexplode(F.arrays_zip(*[f"{c}{k}" for c in kinds for k in range(most)]))
    rows = beside.select(*keep, "_whole", place.alias("at", "x"))

    def window(kind: str, size: int, salt: int) -> Column:
        part = [F.col(f"x.{kind}{k}") for k in range(size)]
        return F.when(part[-1].isNotNull(), F.xxhash64(F.lit(salt), *part))

    entry = lambda kind, size, value: F.struct(F.lit(kind).alias("kind"), F.lit(size).alias("w"), value.alias("window"))
    every = [entry("whole", 0, F.when(F.col("at") == 0, F.col("_whole")))]
    for size in sizes:
        typed, plain = window("t", size, size), window("p", size, size)
        every += [entry("t", size, typed), entry("p", size, F.when(plain != typed, plain))]
    every += [entry("e", size, window("e", size, -size)) for size in exact_sizes]
    return (rows.select(*keep, "at", F.explode(F.array(*every)).alias("x"))
                .select(*keep, "at", "x.kind", "x.w", "x.window").where("window IS NOT NULL"))


def _bound(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value worked out once."""
    return F.get(F.transform(F.array(value), then), 0)


def _against(slots: Column) -> Column:
    """Places of the slots that the alignment's majority contradicts."""
    pair = lambda s: F.struct(s["item"].alias("item"), s["doc"].alias("doc"))
    counted = F.transform(F.array_distinct(F.transform(slots, pair)), lambda p: F.struct(
        p["item"].alias("item"), F.size(F.filter(slots, lambda s: (s["item"] == p["item"]) & (s["doc"] == p["doc"]))).alias("n"),
        (p["item"] == p["doc"]).alias("same"), p["doc"].alias("doc")))
    rank = lambda p: F.struct(p["n"], p["same"], p["doc"])
    best = lambda c: F.filter(c, lambda p: ~F.exists(c, lambda q: (q["item"] == p["item"]) & (rank(q) > rank(p))))
    good = lambda b: F.transform(F.filter(b, lambda p: p["same"] | (
        F.size(F.filter(b, lambda q: q["doc"] == p["doc"])) <= MERGED)), pair)
    out = lambda g: F.transform(F.filter(slots, lambda s: ~F.array_contains(g, pair(s))), lambda s: s["at"])
    return _bound(counted, lambda c: _bound(best(c), lambda b: _bound(good(b), out)))


def _covered(found: str) -> Column:
    """The places of all words of the windows of ``w`` words at ``found``."""
    return F.array_sort(F.array_distinct(F.flatten(F.transform(found, lambda p: F.sequence(p, p + F.col("w") - 1)))))


def _longest_run(places: Column) -> Column:
    """The most consecutive numbers in a sorted array."""
    zero = F.struct(F.lit(-2).alias("last"), F.lit(0).alias("n"), F.lit(0).alias("top"))

    def step(acc, j):
        n = F.when(j == acc["last"] + 1, acc["n"] + 1).otherwise(1)
        return F.struct(j.alias("last"), n.alias("n"), F.greatest(acc["top"], n).alias("top"))

    return F.aggregate(places, zero, step, lambda a: a["top"])


def find(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", item_col: str = "item_id",
         item_text: str = "text", window: int = WINDOW, coverage: float = COVERAGE,
         broadcast_windows: int = BROADCAST_WINDOWS, run: int = RUN) -> DataFrame:
    """One row per document (id and text) and item found in it: ``key`` (hash of
    id and text), id, item, n_windows, item_windows, n_words (the item's literal
    words that they cover), item_words (all of them), n_slots, n_changed (slots of another value)
    and whether that makes it a re-parameterised copy."""
    items = benchmark.select(F.col(item_col).alias("item"), F.col(item_text).cast("string").alias("text")).dropDuplicates()
    items = _templates(items, True).withColumn("item_key", F.xxhash64("item", "text"))
    n = F.size("words")
    shorter = F.greatest(F.lit(min(MIN_WINDOW, window)), F.floor((n - 1) / 2).cast("int"))
    items = items.where(n > 0).withColumn("own", F.when(n < MIN_WORDS, 0).otherwise(F.least(F.lit(window), shorter)))
    literal = F.transform("words", lambda w, j: F.when(~is_slot(w), j))
    valueless = F.transform("words", lambda w, j: F.when(~is_slot(F.translate(w, _NAME, "")), j))  # names are words
    items = written(items.select("item", "item_key", "words", "t", "p", "e", "own", F.array_compact(literal).alias("literal"),
                                 F.array_compact(valueless).alias("valueless")), "benchmark-templates")
    sizes = [r["own"] for r in items.select("own").distinct().where("own > 0").sort("own").collect()]  # WINDOW - MIN_WINDOW + 1 at most
    inside = lambda places: F.size(F.filter(places, lambda j: (j >= F.col("at")) & (j < F.col("at") + F.col("w"))))
    listed = _windows(items, sizes, [], "item", "item_key", "own", "literal", "valueless").where("w = own")
    listed = written(listed.withColumn("n_literal", F.when(F.col("kind") == "p", inside("valueless")).otherwise(inside("literal")))
                     .where((F.col("w") == 0) | (2 * F.col("n_literal") >= F.col("w")))
                     .select("item", "item_key", "kind", "w", F.col("at").alias("item_at"), "window"), "benchmark-windows")
    # what an item's literal windows can cover; items that they cannot tell go by their values
    reach = listed.groupBy("item_key").agg(F.first("w").alias("w"), F.collect_set("item_at").alias("places"))
    reached = _covered("places")
    able = (F.col("own") == 0) | ((F.size(reached) >= MIN_WORDS) & (
        F.size(F.array_intersect(reached, F.col("literal"))) >= F.lit(coverage) * F.size("literal")))
    judged = items.join(reach, "item_key", "left").withColumn("able", F.coalesce(able, F.lit(False)))
    places = F.sequence(F.lit(0), n - 1)
    items = written(judged.select(
        "item", "item_key", "words", "t", "p", "e", "able", F.when(F.col("able"), F.col("own")).otherwise(F.least(F.lit(window), n)).alias("own"),
        F.when(F.col("able") & (F.col("own") > 0), F.col("literal")).otherwise(places).alias("literal")), "benchmark-items")
    by_value = items.where(~F.col("able"))
    exact_sizes = [r["own"] for r in by_value.select("own").distinct().sort("own").collect()]  # WINDOW at most
    probes = listed.join(items.where("able").select("item_key"), "item_key", "left_semi")
    if exact_sizes:
        valued = _windows(by_value, [], exact_sizes, "item", "item_key", "own").where("kind = 'e' AND w = own")
        probes = probes.unionByName(valued.select("item", "item_key", "kind", "w", F.col("at").alias("item_at"), "window"))
    probes = written(probes.select("item_key", "w", "item_at", "window"), "benchmark-probes")
    item_sizes = probes.groupBy("item_key").agg(F.countDistinct("item_at").alias("item_windows"))
    few = probes.count() <= broadcast_windows

    rows = docs.select(F.col(id_col).alias("id"), F.col(text).cast("string").alias("text")).where(F.col("text").isNotNull())
    rows = rows.withColumn("key", F.xxhash64("id", "text"))
    exploded = _windows(_templates(rows, bool(exact_sizes)), sizes, exact_sizes, "key").select("key", "at", "window")
    right = F.broadcast(probes) if few else probes
    hits = exploded.join(right, "window")
    aligned = written(hits.groupBy("key", "item_key", (F.col("at") - F.col("item_at")).alias("shift")).agg(
        F.sort_array(F.collect_set("item_at")).alias("found"), F.first("w").alias("w")), "alignments")

    wanted = aligned.select("key").distinct()
    if wanted.count() <= broadcast_windows:
        wanted = F.broadcast(wanted)
    held = rows.join(wanted, "key", "left_semi").dropDuplicates(["key"])
    held = written(with_words(held).select("key", "id", F.col("words").alias("doc_words")), "matched-documents")
    own = items.select("item", "item_key", "words", "literal", n.alias("item_size"))
    both = aligned.join(held, "key").join(own, "item_key")
    both = both.withColumn("w", F.when(F.col("w") == 0, F.col("item_size")).otherwise(F.col("w")))  # a whole text is one window
    value = lambda w: F.lower(F.translate(w, _NAME, ""))
    slots = F.transform(F.filter(_covered("found"), lambda j: is_slot(F.get("words", j))), lambda j: F.struct(
        j.alias("at"), value(F.get("words", j)).alias("item"),
        value(F.get("doc_words", j + F.col("shift").cast("int"))).alias("doc")))
    both = written(both.select("key", "id", "item", "item_key", "w", "found", "literal", "item_size", slots.alias("slots")), "alignment-slots")
    kept = _bound(_against(F.col("slots")), lambda against: F.filter("found", lambda p: ~F.exists(
        against, lambda j: (j >= p) & (j < p + F.col("w")))))
    both = written(both.withColumn("found", kept), "kept-windows").where(F.size("found") > 0)
    both = both.select("key", "id", "item", "item_key", "found", "literal", "item_size", _covered("found").alias("covered"), F.filter(
        "slots", lambda s: F.exists("found", lambda p: (s["at"] >= p) & (s["at"] < p + F.col("w")))).alias("slots"))
    out = both.groupBy("key", "item_key").agg(
        F.first("id").alias("id"), F.first("item").alias("item"),
        F.size(F.array_distinct(F.flatten(F.collect_list("found")))).cast("long").alias("n_windows"),
        F.first("literal").alias("literal"), F.first("item_size").alias("item_size"),
        F.array_distinct(F.flatten(F.collect_list("covered"))).alias("covered"),
        F.max(_longest_run(F.col("covered"))).alias("run"),
        F.sum(F.size("slots")).cast("long").alias("n_slots"),
        F.sum(F.size(F.filter("slots", lambda s: s["item"] != s["doc"]))).cast("long").alias("n_changed"))
    told = F.size(F.array_intersect("covered", "literal"))
    enough = (told >= F.lit(coverage) * F.size("literal")) & (F.size("covered") >= F.least(F.lit(MIN_WORDS), F.col("item_size")))
    return out.join(item_sizes, "item_key").where(enough | (F.col("run") >= run)).select(
        "key", "id", "item", "n_windows", "item_windows", told.cast("long").alias("n_words"),
        F.size("literal").cast("long").alias("item_words"), "n_slots", "n_changed", (F.col("n_changed") > 0).alias("reparameterised"))


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without those in which an item is found."""
    found = find(docs, benchmark, id_col, text, **options).select("key").distinct()
    name = unused(docs, "_key")
    keyed = docs.withColumn(name, F.xxhash64(F.col(id_col), F.col(text).cast("string")))
    return keyed.join(found.withColumnRenamed("key", name), name, "left_anti").select(*docs.columns)
