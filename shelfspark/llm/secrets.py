"""Secret scan with corpus-wide ownership frequency (DataFrame functions only).

1. Every text is searched for three base kinds (assign, access, hex) and for
   generic candidates: long tokens that mix letters and digits. Positions are
   code points, from the lengths of what lies between the matches.
2. The hash of each candidate's value is counted over the corpus by distinct
   repositories and distinct owners, with map-side partial aggregation.
3. A value held by one owner in at most LIVE_REPOS of its repositories and at most
   LIVE_FOUND times is live-looking; one that several owners or more
   repositories hold, or that occurs more often, is a copied example. Base
   spans always stay and get their class; generic
   spans are added where their value is live-looking and no base span covers
   them.

Only candidates are shuffled, never texts; the join on the value's hash is an
ordinary sort-merge join, whose hot values the adaptive planner splits.
Null texts count as empty, null owners and repositories as one owner each,
repeated rows are scanned one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.session import written

#: Fixed patterns of the contract; a run of at least n characters of a class is
#: the same as a whole run that is n long or longer. (?i:) covers ASCII letters.
ASSIGN = ("(?i:password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?"
          "([A-Za-z0-9+/_.=-]+)")
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "[0-9a-f]{32,}"
#: A generic candidate: 24 or more characters of base64 or similar alphabets.
GENERIC = "[A-Za-z0-9+/_-]{24,}"
MIN_ASSIGN = 8
#: From so many distinct owners on, a value is a copied example.
EXAMPLE_OWNERS = 2
#: Within one owner, a live value is in at most so many distinct repositories, and found at most so often.
LIVE_REPOS, LIVE_FOUND = 2, 10

KINDS = ("assign", "access", "hex", "generic")
_EMPTY = "array<struct<start:bigint,end:bigint,kind:int,value:string>>"


def _spans(kind: int, pattern: str, guard: Column, value, keep) -> Column:
    """Spans of the leftmost, non-overlapping matches of ``pattern`` in ``_text``.

    The text is split at the matches, so a match starts after all earlier gaps
    and matches. Only texts that pass ``guard`` are searched.
    """
    gaps = F.transform(F.split("_text", pattern, -1), lambda g: F.length(g).cast("long"))
    found = F.regexp_extract_all("_text", F.lit(pattern), F.lit(0))
    steps = F.zip_with(gaps, found, lambda g, m: F.struct(g.alias("gap"), m.alias("text")))
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(_EMPTY).alias("out"))

    def step(acc, s):
        start = acc["at"] + s["gap"]
        end = start + F.length(s["text"])
        v = value(s["text"])
        one = F.array(F.struct(start.alias("start"), end.alias("end"), F.lit(kind).alias("kind"), v.alias("value")))
        out = F.when(s["text"].isNotNull() & keep(s["text"], v), F.concat(acc["out"], one)).otherwise(acc["out"])
        return F.struct(F.coalesce(end, start).alias("at"), out.alias("out"))

    return F.when(guard, F.aggregate(steps, zero, step, lambda a: a["out"])).otherwise(F.array().cast(_EMPTY))


def candidates(docs: DataFrame, text: str, repo: Column, owner: Column) -> DataFrame:
    """One row per document: ``_row``, its other columns, ``_repo``, ``_owner``
    and ``_found``, its spans by start."""
    t = F.col("_text")
    whole = lambda m: m
    secret = lambda m: F.regexp_extract(m, ASSIGN, 1)
    mixed = lambda m, v: m.rlike("[0-9]") & m.rlike("[A-Za-z]")
    always = lambda m, v: F.lit(True)
    found = F.concat(
        _spans(0, ASSIGN, t.rlike("(?i:password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]"), secret,
               lambda m, v: F.length(v) >= MIN_ASSIGN),
        _spans(1, ACCESS, t.contains("AKIA"), whole, always),
        _spans(2, HEX, t.rlike(HEX), whole, always),
        _spans(3, GENERIC, t.rlike(GENERIC), whole, mixed),
    )
    out = docs.withColumns({"_row": F.monotonically_increasing_id(), "_repo": F.coalesce(repo.cast("string"), F.lit("")),
                            "_owner": F.coalesce(owner.cast("string"), F.lit("")),
                            "_text": F.coalesce(F.col(text).cast("string"), F.lit(""))})
    return out.withColumn("_found", F.sort_array(found)).drop("_text", text)


def ownership(spans: DataFrame) -> DataFrame:
    """Per value hash: documents, distinct repositories, distinct owners."""
    return (spans.groupBy("hash", "_owner", "_repo").agg(F.count("*").alias("n"))
            .groupBy("hash", "_owner").agg(F.sum("n").alias("n"), F.count("*").alias("repos"))
            .groupBy("hash").agg(F.sum("n").alias("n_found"), F.sum("repos").alias("n_repos"),
                                 F.count("*").alias("n_owners")))


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text", repo: Column | None = None,
         owner: Column | None = None, example_owners: int = EXAMPLE_OWNERS,
         live_repos: int = LIVE_REPOS, live_found: int = LIVE_FOUND) -> DataFrame:
    """``id_col`` and ``found``: array of (start, end, kind, value hash,
    n_repos, n_owners, live), by start, then kind. Every document has a row."""
    repo = F.lit("") if repo is None else repo
    owner = F.lit("") if owner is None else owner
    base = docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_raw"), repo.alias("_r"), owner.alias("_o"))
    rows = written(candidates(base, "_raw", F.col("_r"), F.col("_o")).select("_row", "_id", "_repo", "_owner", "_found"),
                   "secret-candidates")
    spans = (rows.where(F.size("_found") > 0)
             .select("_row", "_repo", "_owner", F.explode("_found").alias("s"))
             .select("_row", "_repo", "_owner", "s.start", "s.end", "s.kind",
                     F.sha2("s.value", 256).alias("hash")))
    labelled = spans.join(ownership(spans), "hash")
    live = (F.col("n_owners") < example_owners) & (F.col("n_repos") <= live_repos) & (F.col("n_found") <= live_found)
    entry = F.struct("start", "end", "kind", "hash", "n_repos", "n_owners", live.alias("live"))
    per_doc = labelled.groupBy("_row").agg(F.sort_array(F.collect_list(entry)).alias("all"))
    inside = lambda x, b: (b["start"] < x["end"]) & (x["start"] < b["end"])
    based = F.filter("all", lambda x: x["kind"] < 3)
    added = F.filter("all", lambda x: (x["kind"] == 3) & x["live"] & ~F.exists(based, lambda b: inside(x, b)))
    per_doc = per_doc.select("_row", F.sort_array(F.concat(based, added)).alias("found"))
    return rows.select("_row", "_id").join(per_doc, "_row", "left").select(
        F.col("_id").alias(id_col),
        F.coalesce("found", F.array().cast(per_doc.schema["found"].dataType)).alias("found"))
