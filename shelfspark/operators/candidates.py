"""Candidate generation from eight sources (CND0-CND9, JN5-JN11, SET1,
DED5, FLT7, AGG10, TOP3-TOP4, WIN3).

The source functions (``user_history`` ... ``location``) return each
source as defined: with ``group_cut=None`` every pair. Four of them fan
out from groups; ``group_classes`` gives the same pairs as class rows with
link counts (linear in users), for jobs that need the source itself.

The final table keeps the ``limit`` lowest ProductIDs per user, which
allows two exact reductions:

1. Per-group cut. Any product in a user's final list is among the
   ``limit`` lowest of every group (category, brand, age group, location,
   partners of a bought product) that proposes it, because the group is a
   subset of the user's union. So each group is one sorted list of ids.
2. Adaptive per-user threshold. Round 1 takes from each of a user's lists
   only the ids below a per-user threshold estimated from list densities;
   a per-user check proves round 1 exact, and only users failing it are
   merged again with whole lists. Lists are merged with array functions;
   a pair becomes a row only when it is known to be kept.

``candidate_lists`` keeps the result as one row per user (ids and source masks,
at most ``limit`` of each), dealt by user over as many tasks as the users need;
joins by user happen in that form, and ``pairs_of`` gives the pairs as rows.

Top-50 lists (trending, discount) are attached to every active user as a
scalar subquery (one aggregate row holding at most 50 ids, a proven
bound) and exploded per user: no cross join and no shuffle of users.

Provenance is a bit mask per (user, product); the surviving source of a
pair is the lowest-numbered one (the reference keeps an arbitrary one) and
``candidate_sources`` lists every source proposing it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from shelfspark.functions.frames import top_k, top_n, union_all

# Candidate sources in priority order (lowest number wins).
SOURCES = ["user_history", "same_category", "brand_affinity", "fbt",
           "age_group", "trending", "discount", "location"]
DEFAULT_LIMIT = 200
DEFAULT_TOP_LIST = 50


def _tag(df: DataFrame, source: str) -> DataFrame:
    return df.select("CustomerID", "ProductID", F.lit(source).alias("candidate_source"))


def _restrict(users: DataFrame, active: DataFrame | None) -> DataFrame:
    """JN5: keep rows of active users (a semi join; NULL users never match)."""
    if active is None:
        return users.where(F.col("CustomerID").isNotNull())
    return users.join(active, "CustomerID", "left_semi")


def _cut(group_products: DataFrame, group: str, group_cut: int | None) -> DataFrame:
    if group_cut is None:
        return group_products
    return top_n(group_products, group, F.col("ProductID").asc(), group_cut)


# Users and products of a group that meet in one cell of its fan-out, and pairs of one task.
BLOCK_USERS = 500
BLOCK_PRODUCTS = 2_000
TASK_PAIRS = 20_000_000


def _blocks(rows: DataFrame, group: str, key: str, size: int) -> DataFrame:
    """(``group``, _times, key + "s"): each group's keys in arrays of about ``size``,
    written; keys that come equally often share arrays, ``_times`` says how often."""
    counted = rows.where(F.col(group).isNotNull()).groupBy(group, key).agg(F.count(F.lit(1)).alias("_times"))
    sizes = counted.groupBy(group).agg(F.ceil(F.count(F.lit(1)) / size).alias("_k"))
    dealt = counted.join(sizes, group).withColumn("_b", F.pmod(F.xxhash64(key), F.col("_k")))
    blocks = dealt.groupBy(group, "_times", "_b").agg(F.collect_list(F.struct(key)).getField(key).alias(f"{key}s"))  # in structs NULL keys stay
    return _written(blocks.drop("_b"), "cand-blocks")


def _fan_out(users: DataFrame, products: DataFrame, group: str, source: str) -> DataFrame:
    """Every (CustomerID, ProductID) of ``users`` join ``products`` on ``group``, tagged.

    The join is made by blocks of users and of products; its cells, far fewer than the
    pairs, are dealt evenly over as many tasks as the pairs need and become pairs
    there, so no task takes a group whole and no pair is shuffled or kept.
    """
    u, p = _blocks(users, group, "CustomerID", BLOCK_USERS), _blocks(products, group, "ProductID", BLOCK_PRODUCTS)
    weight = lambda blocks, keys, n: blocks.groupBy(group).agg(F.sum(F.size(keys) * F.col("_times")).alias(n))
    pairs = weight(u, "CustomerIDs", "_nu").join(weight(p, "ProductIDs", "_np"), group).agg(F.sum(F.col("_nu") * F.col("_np"))).first()[0] or 0
    parts = max(1, -(-pairs // TASK_PAIRS))
    cells = u.join(p.withColumnRenamed("_times", "_times_p"), group).repartition(parts)
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_times") * F.col("_times_p"))).alias("_time")
    # generated code keeps all that comes of one row until it is read; coalesce parts it, so that is never all pairs of a cell
    of_user = cells.select("CustomerIDs", "ProductIDs", times).select(F.explode("CustomerIDs").alias("CustomerID"), "ProductIDs").coalesce(parts)
    return _tag(of_user.select("CustomerID", F.explode("ProductIDs").alias("ProductID")), source)


def active_users(interactions: DataFrame) -> DataFrame:
    """CND0: distinct buyers (NULL user excluded)."""
    return interactions.where(F.col("CustomerID").isNotNull()).select("CustomerID").distinct()


def user_history(interactions: DataFrame) -> DataFrame:
    """CND1: products the user bought (restricting to buyers is a no-op here)."""
    return _tag(interactions.where(F.col("CustomerID").isNotNull()), "user_history")


def same_category(preferences: DataFrame, features: DataFrame, active: DataFrame | None = None,
                  group_cut: int | None = None) -> DataFrame:
    """CND2 / JN6: every product of each category the user bought from."""
    users = _restrict(preferences.select("CustomerID", "Category"), active)
    prods = _cut(features.where(F.col("Category").isNotNull()).select("Category", "ProductID"),
                 "Category", group_cut)
    return _fan_out(users, prods, "Category", "same_category")


def brand_affinity(enriched: DataFrame, features: DataFrame, active: DataFrame | None,
                   group_cut: int | None = None) -> DataFrame:
    """CND3 / JN7: products of every brand the user interacted with (any type)."""
    users = _restrict(enriched.select("CustomerID", "Brand").distinct(), active)
    prods = _cut(features.where(F.col("Brand").isNotNull()).select("Brand", "ProductID"),
                 "Brand", group_cut)
    return _fan_out(users, prods, "Brand", "brand_affinity")


def bought_together(interactions: DataFrame, fbt: DataFrame) -> DataFrame:
    """CND4 / JN8: ProductID_B for every bought ProductID_A (one direction)."""
    ui = interactions.where(F.col("CustomerID").isNotNull()).select("CustomerID", "ProductID")
    pairs = fbt.select("ProductID_A", "ProductID_B")
    j = ui.join(pairs, F.col("ProductID") == F.col("ProductID_A"))
    return j.select("CustomerID", F.col("ProductID_B").alias("ProductID"),
                    F.lit("fbt").alias("candidate_source"))


def age_group(customers_age: DataFrame, agegroup_popular: DataFrame, active: DataFrame | None,
              group_cut: int | None = None) -> DataFrame:
    """CND5 / JN9: products bought in the user's age group."""
    users = _restrict(customers_age.select("CustomerID", "AgeGroup"), active)
    prods = _cut(agegroup_popular.where(F.col("AgeGroup").isNotNull()).select("AgeGroup", "ProductID"),
                 "AgeGroup", group_cut)
    return _fan_out(users, prods, "AgeGroup", "age_group")


def _attach_list(active: DataFrame, ids: DataFrame, source: str) -> DataFrame:
    """Every active user x a bounded id list, via a scalar subquery + explode."""
    lst = ids.agg(F.collect_list("ProductID")).scalar()
    return active.select("CustomerID", F.explode(lst).alias("ProductID"),
                         F.lit(source).alias("candidate_source"))


def top_trending(trending: DataFrame, k: int = DEFAULT_TOP_LIST) -> DataFrame:
    """TOP3: top-k trending products by purchase_count (ties: lower id)."""
    return top_k(trending, [F.col("purchase_count").desc(), F.col("ProductID").asc()], k)


def top_discounted(features: DataFrame, k: int = DEFAULT_TOP_LIST) -> DataFrame:
    """FLT7 + TOP4: top-k products with DiscountPercent > 0 (ties: lower id)."""
    return top_k(features.where(F.col("DiscountPercent") > 0),
                 [F.col("DiscountPercent").desc(), F.col("ProductID").asc()], k)


def trending(active: DataFrame, trending_products: DataFrame, k: int = DEFAULT_TOP_LIST) -> DataFrame:
    """CND6 / JN11: every active user x the top-k trending products."""
    return _attach_list(active, top_trending(trending_products, k).select("ProductID"), "trending")


def discount(active: DataFrame, features: DataFrame, k: int = DEFAULT_TOP_LIST) -> DataFrame:
    """CND7 / JN11: every active user x the top-k discounted products."""
    return _attach_list(active, top_discounted(features, k).select("ProductID"), "discount")


def location(location_pop: DataFrame, customers_age: DataFrame, active: DataFrame | None,
             group_cut: int | None = None) -> DataFrame:
    """CND8 / JN10: products interacted with (any type) in the user's location."""
    users = _restrict(customers_age.select("CustomerID", F.col("Location").alias("CustomerLocation")),
                      active)
    prods = _cut(location_pop.where(F.col("CustomerLocation").isNotNull())
                             .select("CustomerLocation", "ProductID"),
                 "CustomerLocation", group_cut)
    return _fan_out(users, prods, "CustomerLocation", "location")


def candidate_provenance(union: DataFrame, limit: int | None = DEFAULT_LIMIT) -> DataFrame:
    """CND9 as defined: cut the union of tagged sources to the ``limit`` lowest
    distinct ProductIDs per user (all copies kept; None: no cut), then one row per
    pair with its sources. Columns as in ``candidates_with_sources``."""
    kept = union if limit is None else _cut_per_user(union, limit)
    return sources_of(kept.withColumn("_bit", _bit())
                          .groupBy("CustomerID", "ProductID").agg(F.bit_or("_bit").alias("_mask")))


# ---- merge of sorted id lists, with an adaptive per-user cut ----------------
def _bit():
    """The bit of ``candidate_source`` in a mask."""
    return F.coalesce(*[F.when(F.col("candidate_source") == s, F.lit(1 << k)) for k, s in enumerate(SOURCES)])


def sources_of(masked: DataFrame) -> DataFrame:
    """(CustomerID, ProductID, _mask, ...) -> the columns of a candidate pair in place
    of the mask; bit k of it stands for ``SOURCES[k]``."""
    bit = {s: F.col("_mask").bitwiseAND(F.lit(1 << k)) != 0 for k, s in enumerate(SOURCES)}
    return masked.select(
        *[c for c in masked.columns if c != "_mask"],
        F.coalesce(*[F.when(bit[s], F.lit(s)) for s in SOURCES]).alias("candidate_source"),
        F.bit_count("_mask").cast("long").alias("num_sources"),
        F.array_compact(F.array(*[F.when(bit[s], F.lit(s)) for s in sorted(SOURCES)])).alias("candidate_sources"))


def _lowest(ids, limit: int):
    """The ``limit`` lowest distinct ids of arrays of ids, ascending."""
    return F.slice(F.sort_array(F.array_distinct(F.flatten(ids))), 1, limit)


def _cut_per_user(union: DataFrame, limit: int) -> DataFrame:
    """Keep the ``limit`` lowest distinct ProductIDs per user (all copies)."""
    w = Window.partitionBy("CustomerID").orderBy(F.col("ProductID").asc())
    return union.withColumn("_r", F.dense_rank().over(w)).where(F.col("_r") <= limit)


def _written(df: DataFrame, name: str) -> DataFrame:
    from shelfspark.session import written
    return written(df, name)


def group_products(gold: dict) -> DataFrame:
    """(candidate_source, grp, ProductID): the list of every group that four of
    the sources fan out from, each list once."""
    def g(df: DataFrame, col: str, source: str) -> DataFrame:
        return (df.select(F.lit(source).alias("candidate_source"), F.col(col).cast("string").alias("grp"), "ProductID")
                  .where(F.col("grp").isNotNull() & F.col("ProductID").isNotNull()))
    return union_all([
        g(gold["features"], "Category", "same_category"),
        g(gold["features"], "Brand", "brand_affinity"),
        g(gold["agegroup_popular"], "AgeGroup", "age_group"),
        g(gold["location_pop"], "CustomerLocation", "location"),
    ])


def group_members(gold: dict, active: DataFrame) -> DataFrame:
    """(CustomerID, candidate_source, grp): the groups of every active user, each once."""
    def m(users: DataFrame, col: str, source: str) -> DataFrame:
        return users.select("CustomerID", F.lit(source).alias("candidate_source"),
                            F.col(col).cast("string").alias("grp")).where(F.col("grp").isNotNull())
    return union_all([
        # category preferences come from purchases, so every such user is active
        m(_restrict(gold["preferences"].select("CustomerID", "Category"), None), "Category", "same_category"),
        m(_restrict(gold["enriched"].select("CustomerID", "Brand").distinct(), active), "Brand", "brand_affinity"),
        m(_restrict(gold["customers_age"].select("CustomerID", "AgeGroup"), active), "AgeGroup", "age_group"),
        m(_restrict(gold["customers_age"].select("CustomerID", "Location"), active), "Location", "location"),
    ])


def _lists(gold: dict, limit: int) -> DataFrame:
    """(candidate_source, grp, ids): each group's ``limit + 1`` lowest ProductIDs,
    ascending. A product's bought-together partners are a group like the others.
    The per-group window limit runs before the collect, so no group is ever
    gathered whole."""
    partners = gold["fbt"].select(F.lit("fbt").alias("candidate_source"), F.col("ProductID_A").cast("string").alias("grp"),
                                  F.col("ProductID_B").alias("ProductID"))
    cut = top_n(group_products(gold).unionByName(partners), ["candidate_source", "grp"], F.col("ProductID").asc(), limit + 1)
    return cut.groupBy("candidate_source", "grp").agg(F.sort_array(F.collect_list("ProductID")).alias("ids"))


# Id lists of one user that are merged in one step; a user with more groups is merged in two.
MERGED_LISTS = 256
# Users whose lists are merged in one task, whatever the number of users.
TASK_USERS = 2_000


def _merge(lists: DataFrame, users: DataFrame, limit: int, parts: int) -> DataFrame:
    """(CustomerID, _bucket, candidate_source, ids, _left_out) and the ungrouped
    sources of ``users`` -> per user the candidates' ``ids`` and source ``masks``,
    and whether an id that a list left out could belong to the user (``_exact``).

    Lists are merged per (user, source, bucket), then per user, where at most
    eight arrays of ``limit`` ids meet; no step holds more than MERGED_LISTS lists.
    Users are dealt over ``parts`` tasks once; every later step keeps them there.
    """
    merged = lists.groupBy("CustomerID", "candidate_source", "_bucket").agg(
        _lowest(F.collect_list("ids"), limit).alias("ids"), F.min("_left_out").alias("_left_out"))
    rows = union_all([merged.drop("_bucket"), users]).repartition(parts, "CustomerID")
    per_user = rows.groupBy("CustomerID").agg(
        F.collect_list(F.struct(_bit().alias("bit"), "ids")).alias("_by"),
        F.min("_left_out").alias("_left_out"))
    kept = _lowest(F.transform("_by", lambda r: r["ids"]), limit)
    # the limit-th lowest id (NULL: fewer than limit ids, so all belong)
    per_user = per_user.select("CustomerID", "_by", "_left_out", F.try_element_at(kept, F.lit(limit)).alias("_last"))
    exact = F.col("_left_out").isNull() | F.coalesce(F.col("_left_out") > F.col("_last"), F.lit(False))
    each = per_user.select("CustomerID", "_last", exact.alias("_exact"), F.explode("_by").alias("r"))
    pairs = each.select("CustomerID", "_last", "_exact", F.explode("r.ids").alias("ProductID"), F.col("r.bit").alias("bit"))
    masked = (pairs.where(F.col("_last").isNull() | (F.col("ProductID") <= F.col("_last")))
                   .groupBy("CustomerID", "ProductID", "_exact").agg(F.bit_or("bit").cast("short").alias("_mask")))
    packed = masked.groupBy("CustomerID", "_exact").agg(F.sort_array(F.collect_list(F.struct("ProductID", "_mask"))).alias("_p"))
    return packed.select("CustomerID", "_exact", F.col("_p.ProductID").alias("ids"), F.col("_p._mask").alias("masks"))


def pairs_of(lists: DataFrame) -> DataFrame:
    """``candidate_lists`` as one row per candidate pair, with its sources."""
    each = lists.select("CustomerID", F.explode(F.arrays_zip("ids", "masks")).alias("_p"))
    return sources_of(each.select("CustomerID", F.col("_p.ids").alias("ProductID"), F.col("_p.masks").alias("_mask")))


def _own_lists(gold: dict, active: DataFrame, limit: int, top_list: int) -> DataFrame:
    """The sources without groups, as one sorted id list per user and source."""
    none = F.lit(None).cast("long").alias("_left_out")
    history = (top_n(user_history(gold["interactions"]), "CustomerID", F.col("ProductID").asc(), limit)
               .groupBy("CustomerID", "candidate_source").agg(F.sort_array(F.collect_list("ProductID")).alias("ids")))
    def const(ids: DataFrame, source: str) -> DataFrame:
        lst = ids.agg(F.sort_array(F.collect_list("ProductID"))).scalar()  # at most top_list ids
        return active.select("CustomerID", F.lit(source).alias("candidate_source"), lst.alias("ids"), none)
    return union_all([
        history.select("CustomerID", "candidate_source", "ids", none),
        const(top_trending(gold["trending"], top_list).select("ProductID"), "trending"),
        const(top_discounted(gold["features"], top_list).select("ProductID"), "discount"),
    ])


def candidates_with_sources(gold: dict, limit: int = DEFAULT_LIMIT, top_list: int = DEFAULT_TOP_LIST,
                            slack: float = 4.0) -> DataFrame:
    """Final candidates with provenance (feeds FEA1): CustomerID, ProductID,
    candidate_source (lowest-numbered), num_sources, candidate_sources (sorted)."""
    return pairs_of(candidate_lists(gold, limit, top_list, slack))


def candidate_lists(gold: dict, limit: int = DEFAULT_LIMIT, top_list: int = DEFAULT_TOP_LIST,
                    slack: float = 4.0) -> DataFrame:
    """Final candidates, one row per user: CustomerID, ids (ascending), masks (bit k
    stands for ``SOURCES[k]``).

    ``gold`` holds DataFrames: interactions, preferences, features, enriched,
    fbt, customers_age, agegroup_popular, trending, location_pop.

    Same rows as ``candidate_provenance`` of all eight sources, from sorted id
    lists. Every group (category, brand, age group, location, partners of a
    product) has one list of its ``limit + 1`` lowest ids. A group's id density
    is estimated from its list (ids kept / highest id kept); a user's threshold
    is T = slack * limit / (sum of the densities of the user's groups), i.e.
    about ``slack * limit`` ids, counted once per group, expected below T. Round 1 merges of each list the
    ids <= T with the ungrouped sources. Let x be the user's limit-th lowest id
    in round 1 and t the lowest group id left out. If t > x, every id of the
    user's full union below x is in round 1, with every source proposing it:
    round 1 is exact for that user. Users failing the check are merged again with
    whole lists (only if there are any). The estimate only affects speed, never
    the result.
    """
    active = _written(active_users(gold["interactions"]), "cand-active")
    parts = max(1, -(-active.count() // TASK_USERS))
    top = F.least(F.size("ids"), F.lit(limit))
    lists = _written(_lists(gold, limit)
                     .withColumn("_d", top / (F.element_at("ids", top).cast("double") + F.lit(1.0))),
                     "cand-group-lists")
    bought = gold["interactions"].where(F.col("CustomerID").isNotNull()).select(
        "CustomerID", F.lit("fbt").alias("candidate_source"), F.col("ProductID").cast("string").alias("grp"))
    # a user's threshold and number of groups: a partial-aggregated groupBy, then
    # a join, safe for a user with very many groups
    members = _written(group_members(gold, active).unionByName(bought)
                       .join(lists.select("candidate_source", "grp", "_d"), ["candidate_source", "grp"]), "cand-memberships")
    per_user = members.groupBy("CustomerID").agg(
        (F.lit(slack * limit) / F.sum("_d")).alias("_T"), F.ceil(F.count(F.lit(1)) / MERGED_LISTS).alias("_k"))
    taken = (members.select("CustomerID", "candidate_source", "grp").join(per_user, "CustomerID")
                    .join(lists.select("candidate_source", "grp", "ids"), ["candidate_source", "grp"])
                    .withColumn("_bucket", F.pmod(F.xxhash64("grp"), F.col("_k"))))
    low = F.filter("ids", lambda v: v <= F.col("_T"))
    round1 = taken.select("CustomerID", "candidate_source", "_bucket", low.alias("_low"), "ids").select(
        "CustomerID", "candidate_source", "_bucket", F.col("_low").alias("ids"),
        F.try_element_at("ids", F.size("_low") + 1).alias("_left_out"))
    own = _own_lists(gold, active, limit, top_list)
    checked = _written(_merge(round1, own, limit, parts), "cand-round1")
    passed = checked.where("_exact").drop("_exact")
    failed = checked.where(~F.col("_exact")).select("CustomerID").distinct()
    if failed.isEmpty():
        return passed
    whole = taken.join(failed, "CustomerID", "left_semi").select(
        "CustomerID", "candidate_source", "_bucket", F.slice("ids", 1, limit).alias("ids"), F.lit(None).cast("long").alias("_left_out"))
    redo = _merge(whole, own.join(failed, "CustomerID", "left_semi"), limit, parts).drop("_exact")
    return union_all([passed, _written(redo, "cand-redone")])


def final_candidates(gold: dict, limit: int = DEFAULT_LIMIT,
                     top_list: int = DEFAULT_TOP_LIST) -> DataFrame:
    """CND9 gold_candidate_products: (CustomerID, ProductID, candidate_source)."""
    return candidates_with_sources(gold, limit, top_list).select(
        "CustomerID", "ProductID", "candidate_source")


def candidates_among(gold: dict, pairs: DataFrame, top_list: int = DEFAULT_TOP_LIST) -> DataFrame:
    """Every candidate that is among ``pairs`` (CustomerID, ProductID), of all eight sources
    and without a cut per user; columns as in ``candidates_with_sources``.

    A source's pairs are looked up, not fanned out: a given pair is in a group source if
    one of the user's groups has the product. A pair has one row per group of its user or
    of its product, whichever is few, and those are matched on both keys.
    """
    active = active_users(gold["interactions"])
    own = _restrict(pairs.where(F.col("ProductID").isNotNull()).select("CustomerID", "ProductID"), active).distinct()
    key = ["CustomerID", "ProductID"]

    def by_product(users: DataFrame, features: DataFrame, group: str, source: str) -> DataFrame:
        """Groups that a product has one of, and a user many."""
        of = own.join(features.select("ProductID", group), "ProductID")
        return _tag(of.join(users.select("CustomerID", group), ["CustomerID", group], "left_semi"), source)

    def by_user(group: str, products: DataFrame, of_product: str, source: str) -> DataFrame:
        """Groups that a user has one of, and a product many."""
        of = own.join(gold["customers_age"].select("CustomerID", F.col(group).alias("_g")), "CustomerID")
        return _tag(of.join(products.select(F.col(of_product).alias("_g"), "ProductID"), ["_g", "ProductID"], "left_semi"), source)

    def listed(ids: DataFrame, source: str) -> DataFrame:
        return _tag(own.join(F.broadcast(ids.select("ProductID")), "ProductID", "left_semi"), source)  # at most top_list ids

    return candidate_provenance(union_all([
        _tag(own.join(user_history(gold["interactions"]), key, "left_semi"), "user_history"),
        by_product(gold["preferences"], gold["features"], "Category", "same_category"),
        by_product(gold["enriched"], gold["features"], "Brand", "brand_affinity"),
        _tag(own.join(bought_together(gold["interactions"], gold["fbt"]), key, "left_semi"), "fbt"),
        by_user("AgeGroup", gold["agegroup_popular"], "AgeGroup", "age_group"),
        listed(top_trending(gold["trending"], top_list), "trending"),
        listed(top_discounted(gold["features"], top_list), "discount"),
        by_user("Location", gold["location_pop"], "CustomerLocation", "location"),
    ]), None)


# ---- classes of users with the same groups ----------------------------------
def group_classes(members: DataFrame, products: DataFrame) -> tuple[DataFrame, DataFrame]:
    """CND2, CND3, CND5, CND8 without the fan-out: users with the same set of
    groups are one class, so each candidate list is built once and users link to it.

    ``members`` has distinct (CustomerID, grp), ``products`` (grp, ProductID).
    Returns (users, classes):

    * users: CustomerID, class_id, num_candidates: one row per user who has any
      candidate; the class is named by its lowest CustomerID;
    * classes: class_id, grp, num_users, num_products: one row per class and group.

    A user's candidate pairs are ``users`` joined with ``classes`` on class_id and
    with ``products`` on grp; their number is num_candidates. A set of groups is
    told by its size and two xors of its groups' hashes, so no user's groups are
    gathered and a class that a third of all users form is pre-aggregated.
    """
    sizes = products.groupBy("grp").agg(F.count(F.lit(1)).alias("num_products"))
    linked = members.join(sizes, "grp")
    signature = linked.groupBy("CustomerID").agg(
        F.count(F.lit(1)).alias("_n"), F.bit_xor(F.xxhash64("grp")).alias("_a"),
        F.bit_xor(F.xxhash64(F.lit("second"), "grp")).alias("_b"), F.sum("num_products").alias("num_candidates"))
    sig = ["_n", "_a", "_b"]
    named = signature.groupBy(*sig).agg(F.min("CustomerID").alias("class_id"), F.count(F.lit(1)).alias("num_users"))
    users = signature.join(named, sig).select("CustomerID", "class_id", "num_candidates")
    classes = (linked.join(named.select(F.col("class_id").alias("CustomerID"), "num_users"), "CustomerID")
                     .select(F.col("CustomerID").alias("class_id"), "grp", "num_users", "num_products"))
    return users, classes


def source_classes(gold: dict, source: str) -> tuple[DataFrame, DataFrame]:
    """``group_classes`` of one of the four group sources."""
    active = active_users(gold["interactions"])
    own = F.col("candidate_source") == source
    return group_classes(group_members(gold, active).where(own).select("CustomerID", "grp"),
                         group_products(gold).where(own).select("grp", "ProductID"))
