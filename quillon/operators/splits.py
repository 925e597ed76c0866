"""Group-aware splits and folds: long tables fold_membership(fold, compound_id, is_test) and fold_meta.

Random choices are orders by md5(key-seed), so they are the same on any cluster and in SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.functions.hot import join_by_key
from quillon.functions.ordered import numbered, running
from quillon.functions.selection import bars
from quillon.functions.shared import kept
from quillon.functions.text import tanimoto


def _order(key: Column, seed: int) -> Column:
    return F.md5(F.concat(key.cast("string"), F.lit(f"-{seed}")))


def _unit(key: Column, seed: int) -> Column:
    """The order as a number, to balance a distributed sort; ties are broken by the full text."""
    return F.conv(F.substring(_order(key, seed), 1, 13), 16, 10).cast("double")


def split_random(df: DataFrame, seed: int, f: float = 0.2, id_col: str = "compound_id") -> DataFrame:
    """id, bin, is_test: in each class the first round(f * n) by hashed id."""
    keyed = df.select(id_col, "bin").withColumns({"_u": _unit(F.col(id_col), seed), "_o": _order(F.col(id_col), seed)})
    placed = numbered(keyed, ["bin"], "_u", "_o", name="_r")
    sizes = df.groupBy("bin").agg(F.round(f * F.count("*")).alias("_n"))
    return placed.join(F.broadcast(sizes), "bin").select(id_col, "bin", (F.col("_r") <= F.col("_n")).alias("is_test"))


def groups_by_key(df: DataFrame, fn: Callable[[Column], Column], id_col: str = "compound_id") -> DataFrame:
    """df with `group`: fn of the structure; an entity without one is a group of its own."""
    return df.withColumn("group", F.coalesce(fn(F.col("smiles")), F.concat(F.lit("__invalid__"), F.col(id_col).cast("string"))))


def assign_groups(df: DataFrame, seed: int, f: float = 0.2) -> DataFrame:
    """group, n, is_test: groups in hashed order go to test until round(f * n) rows are there (the last may overshoot)."""
    sizes = df.groupBy("group").agg(F.count("*").alias("n")).withColumns({"_u": _unit(F.col("group"), seed), "_o": _order(F.col("group"), seed)})
    summed = running(sizes, [], "_u", ["n"], ties="_o")
    target = sizes.agg(F.round(f * F.sum("n")).alias("_target"))
    return summed.join(F.broadcast(target)).select("group", "n", (F.col("cum_n") - F.col("n") < F.col("_target")).alias("is_test"))


def split_deterministic(df: DataFrame, f: float = 0.2, order: str = "orig_idx") -> DataFrame:
    """group, n, is_test: groups by size (largest first, then first row) join train while it holds at most (1 - f) * n rows,
    else test; smaller groups may still fit after one that did not.

    The greedy rule is sequential over sizes, not groups: equal sizes fill together, so the state runs over the distinct
    sizes only (at most about sqrt(2 n) of them), and groups of one size are told apart by their place.
    """
    sizes = df.groupBy("group").agg(F.count("*").alias("n"), F.min(order).alias("first"))
    room = df.agg(F.floor((1 - f) * F.count("*")).cast("long").alias("room"))
    per_size = sizes.groupBy("n").agg(F.count("*").alias("c"))
    listed = per_size.agg(F.sort_array(F.collect_list(F.struct("n", "c")), asc=False).alias("s")).join(F.broadcast(room))
    begin = F.struct(F.col("room").alias("left"), F.array().cast("array<struct<n:bigint,fit:bigint>>").alias("out"))

    def step(acc, x):
        fit = F.least(F.floor(acc["left"] / x["n"]), x["c"]).cast("long")
        return F.struct((acc["left"] - fit * x["n"]).alias("left"), F.concat(acc["out"], F.array(F.struct(x["n"].alias("n"), fit.alias("fit")))).alias("out"))

    fits = listed.select(F.inline(F.aggregate("s", begin, step, lambda a: a["out"])))
    placed = numbered(sizes, ["n"], "first", "group", name="_r")
    return placed.join(F.broadcast(fits), "n").select("group", "n", (F.col("_r") > F.col("fit")).alias("is_test"))


def set_classes(df: DataFrame, id_col: str = "compound_id", bits: str = "bits") -> DataFrame:
    """id, rep, n: entities with equal sets are one class, named by its greatest id; n is its size. An entity without a
    set (null or empty) is a class of its own. Sets meet by value, so a class of any size is one partial aggregate."""
    sets = df.select(F.col(id_col).alias("id"), F.array_sort(F.array_distinct(bits)).alias("set")).withColumn("set", F.when(F.size("set") > 0, F.col("set")))
    classes = sets.filter(F.col("set").isNotNull()).groupBy("set").agg(F.max("id").alias("rep"), F.count("*").alias("n"))
    named = sets.join(classes, "set", "left")
    return named.select("id", F.coalesce("rep", "id").alias("rep"), F.coalesce("n", F.lit(1)).alias("n"))


def candidate_pairs(sets: DataFrame, t: float) -> DataFrame:
    """a, b (a < b) of sets (id, set) that may be at least t alike: what is left to compare member by member.

    Members are ordered from the rarest on. A set of n members that is this alike to a set of no more members shares one of
    its first n - ceil(t n) + 1, and the smaller one has it among its first n - ceil(2 t n / (1 + t)) + 1; so an inverted
    index of these meets all pairs without frequent members. Pairs whose sizes differ too much are dropped as they meet, and
    so are those whose members behind the one that met are too few for the overlap that is needed."""
    members = sets.select("id", F.size("set").alias("n"), F.explode("set").alias("m"))
    counts = members.groupBy("m").agg(F.count("*").alias("df"))
    rare = members.join(counts, "m").groupBy("id", "n").agg(F.array_sort(F.collect_list(F.struct("df", "m"))).alias("o"))
    first = lambda share: (F.col("n") - F.ceil(F.col("n") * share - 1e-9) + 1).cast("int")
    prefix = lambda share: rare.select("id", "n", F.posexplode(F.slice("o", 1, first(share))).alias("i", "x"))
    small = prefix(2 * t / (1 + t)).select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("i").alias("ia"), F.col("x.m").alias("m"))
    large = prefix(t).select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("i").alias("ib"), F.col("x.m").alias("m"))
    ordered = (F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b")))
    sized = F.col("na") >= t * F.col("nb") - 1e-9
    enough = F.least(F.col("na") - F.col("ia"), F.col("nb") - F.col("ib")) >= F.ceil((F.col("na") + F.col("nb")) * t / (1 + t) - 1e-9)
    met = small.join(large, "m").filter(ordered & sized & enough)
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def similar_pairs(df: DataFrame, cutoff: float = 0.6, id_col: str = "compound_id", bits: str = "bits") -> DataFrame:
    """a, b (a < b), similarity of classes of equal sets (by their greatest ids, see set_classes) whose sets are at least
    1 - cutoff alike; empty sets have no pairs. With set_classes these are all links; copies are not paired."""
    t = 1 - cutoff
    sets = df.select(F.col(id_col).alias("id"), F.array_sort(F.array_distinct(bits)).alias("set")).filter(F.size("set") > 0).groupBy("set").agg(F.max("id").alias("id"))
    both = candidate_pairs(sets, t).join(sets.select(F.col("id").alias("a"), F.col("set").alias("sa")), "a").join(sets.select(F.col("id").alias("b"), F.col("set").alias("sb")), "b")
    return both.withColumn("similarity", tanimoto(F.col("sa"), F.col("sb"))).filter(F.col("similarity") >= t - 1e-9).select("a", "b", "similarity")


def groups_butina(df: DataFrame, cutoff: float = 0.6, id_col: str = "compound_id", bits: str = "bits") -> DataFrame:
    """id, group: Butina clusters; each centroid's group is named by it, an entity without a set is its own group.

    The greedy order (most neighbours first, then the greater id) is fixed beforehand, so the sequential result equals the
    maximal independent set found in rounds: a point that comes before all its undecided neighbours is a centroid, and its
    neighbours are decided. Equal sets have the same neighbours and each other, so their class moves as its greatest id
    does, and the rounds work on classes. Each round is written to the shared folder; the number of rounds is that of the
    longest chain of decreasing priorities.
    """
    classes = kept(set_classes(df, id_col, bits), "classes")
    sizes = classes.select("rep", "n").distinct()
    pairs = similar_pairs(df, cutoff, id_col, bits).select("a", "b")
    edges = kept(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    around = edges.join(sizes.select(F.col("rep").alias("b"), "n"), "b").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("near"))
    deg = F.coalesce("near", F.lit(0)) + F.col("n") - 1
    degree = kept(sizes.join(around, "rep", "left").select(F.col("rep").alias("id"), F.struct(deg.alias("deg"), F.col("rep").alias("id")).alias("rank")), "degrees")
    neighbours = edges.join(degree.select(F.col("id").alias("b"), F.col("rank").alias("rb")), "b")
    open_, centroids = degree, None
    while not open_.isEmpty():
        rivals = neighbours.join(open_.select(F.col("id").alias("b")), "b", "left_semi").groupBy(F.col("a").alias("id")).agg(F.max("rb").alias("best"))
        won = kept(open_.join(rivals, "id", "left").filter(F.col("best").isNull() | (F.col("rank") > F.col("best"))).select("id", "rank"), "won")
        centroids = won if centroids is None else centroids.unionByName(won)
        gone = won.select("id").unionByName(neighbours.join(won.select(F.col("id").alias("b")), "b", "left_semi").select(F.col("a").alias("id"))).distinct()
        open_ = kept(open_.join(gone, "id", "left_anti"), "open")
    if centroids is None:
        return df.select(F.col(id_col).alias("id"), F.col(id_col).alias("group"))
    first = edges.join(centroids.select(F.col("id").alias("b"), "rank"), "b").groupBy(F.col("a").alias("id")).agg(F.max("rank").alias("best"))
    named = degree.join(first, "id", "left").join(centroids.select("id", F.lit(True).alias("is_centroid")), "id", "left")
    group = named.select(F.col("id").alias("rep"), F.when(F.col("is_centroid"), F.col("id")).otherwise(F.col("best.id")).alias("group"))
    return classes.join(group, "rep").select("id", "group")


def both_classes(members: DataFrame) -> DataFrame:
    """fold, ok: both sides have both classes; from (fold, is_test, bin)."""
    sides = members.groupBy("fold", "is_test").agg(F.count_distinct("bin").alias("k"))
    return sides.groupBy("fold").agg(((F.min("k") == 2) & (F.count("*") == 2)).alias("ok"))


def split(df: DataFrame, strategy: str, seed: int, f: float = 0.2, id_col: str = "compound_id") -> DataFrame | None:
    """One split (id, bin, is_test) by name: random, scaffold or butina (both by df.group), deterministic; None if a side
    lacks a class."""
    if strategy == "random":
        out = split_random(df, seed, f, id_col)
    else:
        sides = split_deterministic(df, f) if strategy == "deterministic" else assign_groups(df, seed, f)
        out = df.join(sides.select("group", "is_test"), "group").select(id_col, "bin", "is_test")
    ok = both_classes(out.withColumn("fold", F.lit("x"))).first()
    return out if ok and ok.ok else None


def fold_balance(members: DataFrame) -> DataFrame:
    """fold, n_train, n_test, test_rate, train_rate from (fold, is_test, bin)."""
    test = F.col("is_test")
    return members.groupBy("fold").agg(F.count_if(~test).alias("n_train"), F.count_if(test).alias("n_test"), F.avg(F.when(test, F.col("bin"))).alias("test_rate"), F.avg(F.when(~test, F.col("bin"))).alias("train_rate"))


def fold_jaccard(members: DataFrame) -> DataFrame:
    """a, b (a < b), jaccard of two folds' test sets, 0 if both are empty; one row an entity with the folds it is in."""
    folds = members.select("fold").distinct()
    sizes = members.groupBy("fold").agg(F.count_if("is_test").alias("n"))
    per = members.filter("is_test").groupBy("compound_id").agg(F.array_sort(F.collect_set("fold")).alias("in"))
    x = per.select(F.explode("in").alias("a"), "in").select("a", F.explode("in").alias("b")).filter("a < b").groupBy("a", "b").agg(F.count("*").alias("both"))
    pairs = folds.select(F.col("fold").alias("a")).join(folds.select(F.col("fold").alias("b")), F.col("a") < F.col("b"))
    out = pairs.join(x, ["a", "b"], "left").join(sizes.select(F.col("fold").alias("a"), F.col("n").alias("na")), "a").join(sizes.select(F.col("fold").alias("b"), F.col("n").alias("nb")), "b")
    both = F.coalesce("both", F.lit(0))
    whole = F.col("na") + F.col("nb") - both
    return out.select("a", "b", F.when(whole > 0, both / F.when(whole > 0, whole)).otherwise(0.0).alias("jaccard"))


def _seeded_unit(key: Column, seed: Column) -> Column:
    """_unit for a seed that is a column."""
    return F.conv(F.substring(F.md5(F.concat(key.cast("string"), F.lit("-"), seed.cast("string"))), 1, 13), 16, 10).cast("double")


def _candidate_bars(units: DataFrame, key: str, by: list[str], weight: str | None, pool: int, f: float) -> list[dict]:
    """seed, by and bar: in candidate `seed` the units of hashes up to the bar are on the test side.

    Every unit meets every seed, but only its hash and weight do, and they are counted where they are read; so the shuffle
    holds a histogram for each seed."""
    seed = F.explode(F.sequence(F.lit(0), F.lit(pool - 1))).alias("seed")
    met = units.select(key, *by, *([weight] if weight else []), seed)
    met = met.withColumn("u", _seeded_unit(F.col(key), F.col("seed")))
    got = bars(met, ["seed", *by], "u", F.round(f * F.col("_total")), weight=weight, keep=False)
    return [r.asDict() for r in got.collect()]  # a row a seed and class


def _sides(key: str, bars_: list[dict], by: str | None) -> Column:
    """A long whose bit s says that the unit is on the test side of candidate s."""
    rows = [F.struct(F.lit(b["seed"]).alias("seed"), F.lit(b[by] if by else 0).alias("of"), F.lit(b["bar"]).alias("bar"), F.lit(1 << b["seed"]).alias("bit")) for b in bars_ if b["bar"] is not None]
    if not rows:
        return F.lit(0).cast("long")
    of = F.col(by) if by else F.lit(0)
    hit = lambda x: (x["of"] == of) & (_seeded_unit(F.col(key), x["seed"]) <= x["bar"])
    return F.aggregate(F.array(*rows), F.lit(0).cast("long"), lambda m, x: F.when(hit(x), m.bitwiseOR(x["bit"].cast("long"))).otherwise(m))


def candidates(df: DataFrame, strategy: str, pool: int = 50, f: float = 0.2, id_col: str = "compound_id") -> DataFrame:
    """Units with sides: for `random` each entity (id, bin, n = 1, n1, sides), as split_random deals it by each seed; else
    each group (group, n, n1, sides), as assign_groups does. Stored; at most 62 candidates."""
    if not 0 < pool <= 62:
        raise ValueError(f"1 to 62 candidates, not {pool}")
    if strategy == "random":
        units = kept(df.select(id_col, F.col("bin").cast("int").alias("bin")), "units")
        sides = _sides(id_col, _candidate_bars(units, id_col, ["bin"], None, pool, f), "bin")
        return kept(units.select("*", F.lit(1).cast("long").alias("n"), F.col("bin").cast("long").alias("n1"), sides.alias("sides")), "sides")
    units = kept(df.groupBy("group").agg(F.count("*").alias("n"), F.sum("bin").cast("long").alias("n1")), "units")
    return kept(units.select("*", _sides("group", _candidate_bars(units, "group", [], "n", pool, f), None).alias("sides")), "sides")


def choose_candidates(units: DataFrame, k: int, pool: int = 50, f: float = 0.2) -> list[dict]:
    """Up to k candidates (seed, balance, mean_jaccard): first the best quality, then the least of quality and the largest
    Jaccard with those chosen; of equals (to 12 digits) the least seed. Candidates that lack a class on a side are left out.

    Class rates are one aggregate with two sums a candidate; overlaps with a chosen one are a sum a candidate."""
    bit = lambda i: F.col("sides").bitwiseAND(F.lit(1 << i)) != 0
    every = range(pool)
    one = units.agg(F.sum("n").alias("n"), F.sum("n1").alias("n1"), *(F.sum(F.when(bit(i), F.col(c))).alias(f"{c}_{i}") for i in every for c in ("n", "n1"))).first()
    n, n1 = one["n"] or 0, one["n1"] or 0
    balance, quality = {}, {}
    for i in every:
        nt, pt = one[f"n_{i}"] or 0, one[f"n1_{i}"] or 0
        if 0 < pt < nt and 0 < n1 - pt < n - nt:
            balance[i] = abs((n1 - pt) / (n - nt) - n1 / n) + abs(pt / nt - n1 / n)
            quality[i] = balance[i] + abs(nt / n - f)
    chosen: list[int] = []
    shared: dict[int, dict[int, float]] = {}
    while len(chosen) < min(k, len(quality)):
        worst = {i: max((shared[j][i] for j in chosen), default=0.0) for i in quality}
        new = min((i for i in quality if i not in chosen), key=lambda i: (round(quality[i] + worst[i], 12), i))
        chosen.append(new)
        both = units.filter(bit(new)).agg(*(F.sum(F.when(bit(i), F.col("n"))).alias(f"b{i}") for i in every)).first()
        shared[new] = {i: (both[f"b{i}"] or 0) / (one[f"n_{i}"] + one[f"n_{new}"] - (both[f"b{i}"] or 0)) for i in quality}
    return [{"seed": i, "balance": balance[i], "mean_jaccard": sum(shared[i][j] for j in chosen if j != i) / max(len(chosen) - 1, 1)} for i in chosen]


def select_folds(df: DataFrame, strategy: str, k: int, pool: int = 50, f: float = 0.2, id_col: str = "compound_id") -> tuple[DataFrame, list[dict]]:
    """k folds from `pool` seeded candidates: membership (fold, compound_id, bin, is_test) and their meta rows.

    `random` draws stratified candidates; any other strategy deals whole groups (column group)."""
    units = candidates(df, strategy, pool, f, id_col)
    meta = [{"fold": f"{strategy}_{i:02d}", "strategy": strategy, **c} for i, c in enumerate(choose_candidates(units, k, pool, f))]
    rows = units.select(id_col, "bin", "sides") if strategy == "random" else join_by_key(df.select(id_col, "bin", "group"), units.select("group", "n", "sides"), "group", "n")
    folds = [F.struct(F.lit(m["fold"]).alias("fold"), (F.col("sides").bitwiseAND(F.lit(1 << m["seed"])) != 0).alias("is_test")) for m in meta]
    named = rows.withColumn("_f", F.array(*folds)) if folds else rows.limit(0).withColumn("_f", F.array(F.struct(F.lit("").alias("fold"), F.lit(False).alias("is_test"))))
    member = named.select(F.col(id_col).alias("compound_id"), "bin", F.inline("_f"))
    return member.select("fold", "compound_id", "bin", "is_test"), meta


MENU = ("random", "scaffold", "deterministic", "butina")


def build_folds(df: DataFrame, repeats: int = 3, schemas: tuple[str, ...] = MENU, groups: dict[str, DataFrame] | None = None, pool: int = 50, f: float = 0.2) -> tuple[DataFrame, list[dict]]:
    """The fold menu, in the order of MENU: `repeats` of each seeded strategy and one deterministic split.

    groups: (compound_id, group) for scaffold (the deterministic split uses it too) and butina; by default df's column
    group for scaffold. The deterministic split stays even where a side lacks a class; a strategy without a usable
    candidate gives no folds."""
    parts, metas = [], []
    rows = df.select("compound_id", "bin")
    for s in [m for m in MENU if m in schemas]:
        of = (groups or {}).get("scaffold" if s == "deterministic" else s)
        data = rows if s == "random" else rows.join(of.select("compound_id", "group"), "compound_id") if of is not None else df
        if s == "deterministic":
            first = data if "orig_idx" in data.columns else data.withColumn("orig_idx", F.col("compound_id"))
            sides = kept(split_deterministic(first, f), "sides")
            member = join_by_key(data.select("compound_id", "bin", "group"), sides, "group", "n")
            parts.append(member.select(F.lit("deterministic_00").alias("fold"), "compound_id", "bin", "is_test"))
            metas.append({"fold": "deterministic_00", "strategy": s, "seed": None, "balance": None, "mean_jaccard": None})
        else:
            member, meta = select_folds(data, s, repeats, pool, f)
            parts.append(member)
            metas += meta
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out, metas


def fold_summary(metrics: DataFrame, value: str = "auroc") -> DataFrame:
    """strategy, mean, population deviation and sorted values over folds; NaN and null are left out."""
    v = F.when(~F.isnan(value), F.col(value))
    return metrics.groupBy("strategy").agg(F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"), F.array_sort(F.collect_list(v)).alias("values"))

