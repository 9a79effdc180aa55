"""Weighted gauges: trees of cross-sectional percent ranks.

A tree is three small tables: nodes (path, parent, weight, reference), components (leaf, name, weight, kind) and
alternatives (leaf, name, idx, code, tier, direction).  Output grids hold every year, country and node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import stage
from . import ranks
from .indicators import rank_within

#: Levels below the root that a tree may have, references included.
DEEPEST = 12


def component_weights(components: DataFrame, nodes: DataFrame) -> DataFrame:
    """Components with their weight: a leaf's size components share its size_share equally, the others the rest."""
    n = F.count("*").over(Window.partitionBy("leaf", "kind"))
    share = F.when(F.col("kind") == "size", F.col("size_share")).otherwise(1 - F.col("size_share"))
    return components.join(nodes.select(F.col("path").alias("leaf"), "size_share"), "leaf").withColumn("weight", share / n).drop("size_share")


def rescaled(nodes: DataFrame) -> DataFrame:
    """Nodes whose sibling weights sum to 1."""
    return nodes.withColumn("weight", F.col("weight") / F.sum("weight").over(Window.partitionBy("parent")))


def effective_weights(nodes: DataFrame) -> DataFrame:
    """(path, depth, effective): products of weights from the roots down, one join per level."""
    level = nodes.filter("parent IS NULL").select("path", F.lit(0).alias("depth"), F.col("weight").cast("double").alias("effective"))
    out = level
    child = nodes.filter("parent IS NOT NULL").select("path", "parent", "weight")
    for depth in range(1, DEEPEST + 1):
        level = stage(level.withColumnRenamed("path", "parent").join(child, "parent").select("path", F.lit(depth).alias("depth"), (F.col("effective") * F.col("weight")).alias("effective")))
        if level.isEmpty():
            return out
        out = out.unionByName(level)
    raise ValueError(f"the tree is deeper than {DEEPEST} levels or has a cycle")


def weight_sums(nodes: DataFrame, components: DataFrame) -> DataFrame:
    """(parent, total, ok): sums of sibling and component weights, which should be 1 within 0.001."""
    a = nodes.filter("parent IS NOT NULL").groupBy("parent").agg(F.sum("weight").alias("total"))
    b = components.groupBy(F.col("leaf").alias("parent")).agg(F.sum("weight").alias("total"))
    return a.unionByName(b).withColumn("ok", F.abs(F.col("total") - 1) <= 1e-3)


def retained(rows: DataFrame, alternatives: DataFrame, also: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of codes that the tree or another list (code) uses, and the codes of the others."""
    used = alternatives.select("code").unionByName(also.select("code")).distinct()
    mine = rows.withColumnRenamed("indicator_code", "code")
    return mine.join(used, "code", "left_semi").withColumnRenamed("code", "indicator_code"), mine.join(used, "code", "left_anti").select("code").distinct()


def years(rows: DataFrame, floor: int) -> DataFrame:
    """Years with a value that isn't projected, from the floor on."""
    return rows.filter(~F.col("is_projection") & (F.col("year") >= floor)).select("year").distinct()


def rank_support(rows: DataFrame, grid: DataFrame) -> DataFrame:
    """(indicator_code, year, n): reporting countries, 0 included."""
    codes = rows.select("indicator_code").distinct().join(grid, how="cross")
    n = rows.groupBy("indicator_code", "year").agg(F.count_distinct("country_code").alias("n"))
    return codes.join(n, ["indicator_code", "year"], "left").fillna(0, ["n"])


def percent_ranks(rows: DataFrame, directions: DataFrame, least: int = 30) -> DataFrame:
    """(indicator_code, direction, year, country_code, score): mean rank of value * direction among `least` countries or more, 0 to 100."""
    each = rows.join(directions.select(F.col("code").alias("indicator_code"), "direction").distinct(), "indicator_code").withColumn("v", F.col("value") * F.col("direction"))
    by = ["indicator_code", "direction", "year"]
    n = F.count("*").over(Window.partitionBy(*by))
    each = each.withColumn("n", n).withColumn("score", (rank_within(each, by, "v") - 1) / (F.col("n") - 1) * 100)
    return each.filter(F.col("n") >= least).select(*by, "country_code", "score")


def coalesce_alternatives(ranks: DataFrame, alternatives: DataFrame, rows: DataFrame, proxies: bool = False) -> DataFrame:
    """(leaf, name, year, country_code, score, idx): the score of a component's first usable alternative.

    The primary alternative is the first whose code has any value that isn't projected; later ones fill
    gaps only if exact or substitute, or if proxies are allowed.
    """
    alive = rows.filter(~F.col("is_projection")).select(F.col("indicator_code").alias("code")).distinct().withColumn("alive", F.lit(True))
    alts = alternatives.join(alive, "code", "left")
    first = F.min(F.when(F.col("alive"), F.col("idx"))).over(Window.partitionBy("leaf", "name"))
    alts = alts.withColumn("primary", first).filter((F.col("idx") == F.col("primary")) | ((F.col("idx") > F.col("primary")) & (F.col("tier").isin("exact", "substitute") | F.lit(proxies))))
    scored = ranks.join(alts.select("leaf", "name", "idx", F.col("code").alias("indicator_code"), "direction"), ["indicator_code", "direction"])
    return scored.groupBy("leaf", "name", "year", "country_code").agg(F.min_by("score", "idx").alias("score"), F.min("idx").alias("idx"))


def _mean(weight: str, score: str) -> tuple:
    present = F.sum(F.when(F.col(score).isNotNull(), F.col(weight)))
    return F.try_divide(F.sum(F.col(weight) * F.col(score)), present), present


def leaf_scores(chosen: DataFrame, components: DataFrame, grid: DataFrame) -> DataFrame:
    """(path, year, country_code, score, weight_present) of the leaves on the whole grid (year, country_code)."""
    every = components.select("leaf", "name", "weight").join(grid, how="cross").join(chosen, ["leaf", "name", "year", "country_code"], "left")
    score, present = _mean("weight", "score")
    return every.groupBy(F.col("leaf").alias("path"), "year", "country_code").agg(score.alias("score"), F.coalesce(present / F.sum("weight"), F.lit(0.0)).alias("weight_present"))


def node_scores(leaves: DataFrame, nodes: DataFrame) -> DataFrame:
    """Leaves and all nodes above them, level by level; a node with a reference has the score of the node it names.

    A round evaluates the nodes all of whose children (or whose reference) are known; a round without
    progress means a cycle and raises.
    """
    edges = nodes.filter("parent IS NOT NULL").select("parent", "path", "weight")
    refs = nodes.filter("reference IS NOT NULL").select("path", "reference")
    known = stage(leaves.select("path", "year", "country_code", "score", "weight_present"))
    todo = nodes.select("path").count()
    for _ in range(DEEPEST):
        done = known.select("path").distinct()
        if done.count() >= todo:
            return known
        open_ = edges.join(done, "path", "left_anti").select("parent").distinct()
        ready = edges.join(open_, "parent", "left_anti").join(done.withColumnRenamed("path", "parent"), "parent", "left_anti")
        score, present = _mean("weight", "score")
        up = known.join(ready, "path").groupBy(F.col("parent").alias("path"), "year", "country_code").agg(score.alias("score"), F.try_divide(F.sum(F.col("weight") * F.col("weight_present")), F.sum("weight")).alias("weight_present"))
        named = refs.join(done, "path", "left_anti")
        same = known.withColumnRenamed("path", "reference").join(named, "reference").drop("reference").select(*known.columns)
        new = stage(up.unionByName(same))
        if new.isEmpty():
            raise ValueError("a reference leads back to itself, or names no node")
        known = stage(known.unionByName(new))
    raise ValueError(f"the tree is deeper than {DEEPEST} levels")


def run(rows: DataFrame, nodes: DataFrame, components: DataFrame, alternatives: DataFrame, countries: DataFrame, floor: int, least: int = 30, proxies: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(components' scores, nodes' scores, rank support) of a gauge tree."""
    span = years(rows, floor)
    grid = span.join(countries.select("country_code").distinct(), how="cross")
    inside = rows.join(span, "year", "left_semi").join(countries.select("country_code").distinct(), "country_code", "left_semi")
    ranks = percent_ranks(inside, alternatives, least)
    chosen = stage(coalesce_alternatives(ranks, alternatives, rows, proxies))
    leaves = leaf_scores(chosen, components, grid)
    full = components.select("leaf", "name").join(grid, how="cross").join(chosen, ["leaf", "name", "year", "country_code"], "left").fillna(-1, ["idx"])
    return full, node_scores(leaves, nodes), rank_support(inside, span)


def quality_only(chosen: DataFrame, components: DataFrame) -> DataFrame:
    """Leaf scores from intensity components alone."""
    part = components.filter("kind = 'intensity'").select("leaf", "name", "weight")
    score, _ = _mean("weight", "score")
    return chosen.join(part, ["leaf", "name"]).groupBy("leaf", "year", "country_code").agg(score.alias("quality"))


def comparison(scores: DataFrame, gauges: list[str], year: int) -> DataFrame:
    """Countries by gauges for one year."""
    return scores.filter(F.col("year") == year).groupBy("country_code").pivot("path", gauges).agg(F.first("score"))


# Reports on a run.


def source_ledger(alternatives: DataFrame, rows: DataFrame) -> DataFrame:
    """Components with the tier of their best alternative that has data (exact, substitute, proxy), or gap."""
    alive = rows.select(F.col("indicator_code").alias("code")).distinct().withColumn("alive", F.lit(True))
    order = F.create_map(*[F.lit(x) for pair in {"exact": 0, "substitute": 1, "proxy": 2}.items() for x in pair])
    best = F.min(F.when(F.col("alive"), order[F.col("tier")]))
    return alternatives.join(alive, "code", "left").groupBy("leaf", "name").agg(F.when(best == 0, "live").when(best == 1, "substitute").when(best == 2, "proxy").otherwise("gap").alias("status"), F.count_if(F.col("alive").isNull()).alias("n_dead"))


def series_health(rows: DataFrame, n_countries: int, least: int = 30) -> DataFrame:
    """Per code: coverage, first year with enough countries, whether constant, whether projected in part."""
    by = rows.groupBy("indicator_code", "year").agg(F.count_distinct("country_code").alias("n"))
    first = by.filter(F.col("n") >= least).groupBy("indicator_code").agg(F.min("year").alias("first_ranked"))
    all_ = rows.groupBy("indicator_code").agg((F.count_distinct("country_code") / n_countries).alias("coverage"), (F.count_distinct("value") <= 1).alias("degenerate"), F.bool_or("is_projection").alias("projected"), F.min("year").alias("first_year"), F.max("year").alias("last_year"))
    return all_.join(first, "indicator_code", "left")


def alternative_switches(chosen: DataFrame) -> DataFrame:
    """Per component: country-years with a score, how many alternatives they use, countries that use several."""
    by = chosen.groupBy("leaf", "name", "country_code").agg(F.count_distinct("idx").alias("k"), F.count("*").alias("n"))
    total = chosen.groupBy("leaf", "name").agg(F.count_distinct("idx").alias("n_alternatives"))
    return by.groupBy("leaf", "name").agg(F.sum("n").alias("n_scored"), F.count_if(F.col("k") > 1).alias("n_switching")).join(total, ["leaf", "name"])


def alternative_agreement(rows: DataFrame, alternatives: DataFrame, targets: DataFrame | None = None, least: int = 5) -> DataFrame:
    """(leaf, name, a, b, n, rho) of a component's alternatives a and b over the country-years with both, n at least `least`.

    With targets (country_code) also n_target and rho_target, over those countries; rho_target is null below `least`.
    """
    marked = rows if targets is None else rows.join(targets.select("country_code", F.lit(True).alias("target")).distinct(), "country_code", "left")
    found = ranks.vectors(marked, "indicator_code", ["country_code", "year"], mark=None if targets is None else F.col("target"))
    alt = lambda s: alternatives.select("leaf", "name", F.col("idx").alias(f"i{s}"), F.col("code").alias(s), F.col("direction").alias(f"d{s}"))
    pairs = alt("a").join(alt("b"), ["leaf", "name"]).filter("ia < ib")
    both = ranks.named_pairs(found, pairs).filter(F.col("n") >= least)
    sign = F.signum(F.col("da") * F.col("db"))
    out = both.select("leaf", "name", F.col("ia").alias("a"), F.col("ib").alias("b"), "n", (sign * F.col("rho")).alias("rho"), F.col("n_marked").alias("n_target"), F.when(F.col("n_marked") >= least, sign * F.col("rho_marked")).alias("rho_target"))
    return out.drop("n_target", "rho_target") if targets is None else out


def structure_checks(nodes: DataFrame, components: DataFrame, alternatives: DataFrame) -> DataFrame:
    """(check, item): codes that stand twice in a component, references and leaves that name no node."""
    twice = alternatives.groupBy("leaf", "name", "code").count().filter("count > 1").select(F.lit("duplicate code").alias("check"), F.concat_ws("/", "leaf", "name", "code").alias("item"))
    refs = nodes.filter("reference IS NOT NULL").select(F.col("reference").alias("path")).join(nodes.select("path"), "path", "left_anti").select(F.lit("unresolved reference").alias("check"), F.col("path").alias("item"))
    leaves = components.select(F.col("leaf").alias("path")).distinct().join(nodes.select("path"), "path", "left_anti").select(F.lit("unknown leaf").alias("check"), F.col("path").alias("item"))
    return twice.unionByName(refs).unionByName(leaves)


def deviation(rows: DataFrame, published: DataFrame) -> DataFrame:
    """Per code: median and largest relative deviation from published values, share within 0.3."""
    both = rows.join(published.select("country_code", "indicator_code", "year", F.col("value").alias("ref")), ["country_code", "indicator_code", "year"]).withColumn("d", F.try_divide(F.abs(F.col("value") - F.col("ref")), F.abs("ref")))
    return both.groupBy("indicator_code").agg(F.percentile("d", F.lit(0.5)).alias("median"), F.max("d").alias("largest"), (F.count_if(F.col("d") <= 0.3) / F.count("d")).alias("within"))


def registry(rows: DataFrame, alternatives: DataFrame, carried: DataFrame, inputs: DataFrame) -> DataFrame:
    """Per code: source, countries, first and last year, and why it is kept.

    stand_in if the tree names it as a proxy alone, wired if it names it otherwise, carried or derived_input if one of those lists
    (code) has it, else no_consumer.  Of several sources the first in the alphabet is given.
    """
    in_tree = alternatives.groupBy("code").agg(F.bool_and(F.col("tier") == "proxy").alias("proxies"), F.array_join(F.array_sort(F.collect_set("leaf")), "; ").alias("leaves"))
    found = rows.groupBy(F.col("indicator_code").alias("code")).agg(F.min("source").alias("source"), F.count_distinct("country_code").alias("n_countries"), F.min("year").alias("first_year"), F.max("year").alias("last_year"))
    found = found.join(in_tree, "code", "left")
    for name, codes in (("carried", carried), ("derived_input", inputs)):
        found = found.join(codes.select("code", F.lit(True).alias(name)).distinct(), "code", "left")
    status = F.when(F.col("proxies"), "stand_in").when(~F.col("proxies"), "wired").when(F.col("carried"), "carried").when(F.col("derived_input"), "derived_input").otherwise("no_consumer")
    return found.select("code", "source", "n_countries", "first_year", "last_year", status.alias("status"), F.coalesce("leaves", F.lit("")).alias("leaves"))


def alternative_coverage(alternatives: DataFrame, rows: DataFrame, weights: DataFrame) -> DataFrame:
    """Per alternative: reporting countries, their weight (country_code, weight), and whether it is dead: no data, but no declared gap either."""
    reporting = rows.select(F.col("indicator_code").alias("code"), "country_code").distinct().join(weights, "country_code", "left")
    by = reporting.groupBy("code").agg(F.count("*").alias("countries"), F.coalesce(F.sum("weight"), F.lit(0.0)).alias("weighted"))
    out = alternatives.join(by, "code", "left").fillna(0, ["countries"]).fillna(0.0, ["weighted"])
    return out.select("leaf", "name", "idx", "code", "tier", "countries", "weighted", ((F.col("countries") == 0) & (F.col("tier") != "gap")).alias("dead"))


def _gauge_of(nodes: DataFrame) -> DataFrame:
    """(gauge, path): the child of a root above each node, or the node itself."""
    top = nodes.filter("parent IS NULL").select(F.col("path").alias("parent"))
    gauge = nodes.join(top, "parent").select(F.col("path").alias("gauge"), "path")
    step = gauge
    for _ in range(DEEPEST):
        step = nodes.select("path", "parent").join(step.select("gauge", F.col("path").alias("parent")), "parent").select("gauge", "path")
        if step.isEmpty():
            break
        gauge = gauge.unionByName(step)
    return gauge


def weight_shares(nodes: DataFrame, components: DataFrame, alternatives: DataFrame, rows: DataFrame) -> DataFrame:
    """(gauge, by, value, share): the share of each gauge's nominal weight by the state and by the tier of its components.

    A gauge is a child of a root.  A component is live with the tier of its first alternative that has data; without one it is a
    gap if its first alternative is declared so, else dead, and its tier is gap.
    """
    alive = rows.select(F.col("indicator_code").alias("code")).distinct().withColumn("alive", F.lit(True))
    alts = alternatives.join(alive, "code", "left")
    state = alts.groupBy("leaf", "name").agg(F.min_by("tier", F.when(F.col("alive"), F.col("idx"))).alias("tier"), F.bool_or(F.coalesce("alive", F.lit(False))).alias("live"), F.min_by("tier", "idx").alias("first_tier"))
    state = state.select("leaf", "name", F.when(F.col("live"), "live").when(F.col("first_tier") == "gap", "gap").otherwise("dead").alias("state"), F.when(F.col("live"), F.col("tier")).otherwise("gap").alias("tier"))
    gauge = _gauge_of(nodes)
    each = components.join(effective_weights(nodes).select(F.col("path").alias("leaf"), "effective"), "leaf").join(gauge.withColumnRenamed("path", "leaf"), "leaf").join(state, ["leaf", "name"], "left")
    each = each.withColumn("w", F.col("effective") * F.col("weight"))
    both = each.select("gauge", "w", F.explode(F.array(F.struct(F.lit("state").alias("by"), F.coalesce("state", F.lit("dead")).alias("value")), F.struct(F.lit("tier").alias("by"), F.coalesce("tier", F.lit("gap")).alias("value")))).alias("x"))
    sums = both.groupBy("gauge", "x.by", "x.value").agg(F.sum("w").alias("w"))
    return sums.select("gauge", "by", "value", (F.col("w") / F.sum("w").over(Window.partitionBy("gauge", "by"))).alias("share"))


def direction_map(alternatives: DataFrame, ambiguous: str, costs: str = "GDP") -> DataFrame:
    """(code, leaf, direction, tier, ambiguous): a code's sign in each leaf, the first alternative's by name and idx.

    ambiguous is a pattern of codes whose sign deserves a second look; so does that of a cost measured by `costs`.
    """
    doubt = F.col("code").rlike(ambiguous) | (F.contains(F.col("name"), F.lit("cost")) & F.contains(F.col("code"), F.lit(costs)))
    best = F.min(F.struct("name", "idx", "direction", "tier", doubt.alias("ambiguous"))).alias("x")
    return alternatives.groupBy("code", "leaf").agg(best).select("code", "leaf", "x.direction", "x.tier", "x.ambiguous")


def proxy_candidates(alternatives: DataFrame, scored: DataFrame, rows: DataFrame, targets: DataFrame) -> DataFrame:
    """(leaf, name, code, added, added_targets): the country-years that a component lacks and its proxy alternatives have.

    scored: the whole grid (leaf, name, year, country_code, score), score null where the component has none; targets: (country_code).
    """
    proxies = alternatives.filter("tier = 'proxy' AND idx > 0").select("leaf", "name", "code")
    lacking = scored.filter("score IS NULL").select("leaf", "name", "year", "country_code")
    have = rows.select(F.col("indicator_code").alias("code"), "year", "country_code").distinct()
    alive = proxies.join(have.select("code").distinct(), "code", "left_semi")
    added = lacking.join(alive, ["leaf", "name"]).join(have, ["code", "year", "country_code"], "left_semi").join(targets.select("country_code", F.lit(1).alias("target")).distinct(), "country_code", "left")
    counts = added.groupBy("leaf", "name", "code").agg(F.count("*").alias("added"), F.count("target").alias("added_targets"))
    return alive.join(counts, ["leaf", "name", "code"], "left").fillna(0, ["added", "added_targets"])


def published_agreement(scores: DataFrame, published: DataFrame, path: str, year: int, present: float = 0.6, least: int = 10) -> DataFrame:
    """(which, n, rho): rank agreement of a node's scores with published ones (country_code, score), over all common countries and over those with enough weight present; rho is null below `least`."""
    mine = scores.filter((F.col("path") == path) & (F.col("year") == year) & F.col("score").isNotNull()).select("country_code", "score", "weight_present")
    both = mine.join(published.select("country_code", F.col("score").alias("ref")).filter("ref IS NOT NULL"), "country_code")
    each = both.select(F.explode(F.filter(F.array(F.struct(F.lit("all").alias("which"), F.lit(True).alias("ok")), F.struct(F.lit("present").alias("which"), (F.col("weight_present") >= present).alias("ok"))), lambda x: x["ok"])).alias("x"), "score", "ref").select("x.which", "score", "ref")
    each = each.withColumn("ra", rank_within(each, ["which"], "score")).withColumn("rb", rank_within(each, ["which"], "ref"))
    return each.groupBy("which").agg(F.count("*").alias("n"), F.when(F.count("*") >= least, F.corr("ra", "rb")).alias("rho"))


#: Tiers from the best to the worst, and the status that a source has through each.
TIERS = {"exact": "live", "substitute": "substitute", "proxy": "proxy"}


def cited_ledger(sources: DataFrame, cites: DataFrame, alternatives: DataFrame, rows: DataFrame) -> DataFrame:
    """One row per cited source: how many components cite it, what data they have, and its status with a reason.

    sources: id, reason (why it may have no consumer); cites: leaf, name, id; alternatives: leaf, name, idx, code, tier, reason (of a declared gap).
    skipped without a component, else live, substitute or proxy by the best tier with data, else gap with the reason of
    its first declared one, else dead.
    """
    data = rows.groupBy(F.col("indicator_code").alias("code")).agg(F.count_distinct("country_code").alias("n"), F.max("year").alias("last"))
    alts = cites.select("leaf", "name", "id").distinct().join(alternatives, ["leaf", "name"], "left").join(data, "code", "left")
    order = F.create_map(*[F.lit(x) for i, t in enumerate(TIERS) for x in (t, i)])
    alive = F.col("n").isNotNull()
    found = alts.groupBy("id").agg(
        F.count_distinct("leaf", "name").alias("n_components"), F.array_join(F.array_sort(F.collect_set(F.when(alive, F.col("code")))), ", ").alias("codes_with_data"), F.coalesce(F.max("n"), F.lit(0)).alias("n_countries"), F.max("last").alias("latest_year"),
        F.min(F.when(alive, order[F.col("tier")])).alias("best"), F.min(F.when(F.col("tier") == "gap", F.struct("leaf", "name", "idx", "reason"))).alias("gap"),
    )
    out = sources.select("id", F.col("reason").alias("own_reason")).join(found, "id", "left").withColumn("n_components", F.coalesce("n_components", F.lit(0)))
    status = F.when(F.col("n_components") == 0, "skipped").when(F.col("best").isNotNull(), F.get(F.array(*map(F.lit, TIERS.values())), F.col("best"))).when(F.col("gap").isNotNull(), "gap").otherwise("dead")
    reason = F.when(F.col("status") == "skipped", F.coalesce("own_reason", F.lit("NO_CONSUMER"))).when(F.col("status") == "gap", F.col("gap.reason")).when(F.col("status") == "dead", "NO_ROWS").otherwise("")
    out = out.withColumn("status", status).withColumn("reason", reason)
    return out.select("id", "n_components", F.coalesce("codes_with_data", F.lit("")).alias("codes_with_data"), F.coalesce("n_countries", F.lit(0)).alias("n_countries"), "latest_year", "status", "reason")


def weighted_health(rows: DataFrame, weights: DataFrame, n_countries: int, recent: int, least: int = 30, few: int = 5) -> DataFrame:
    """Per code, over its actual values (over projected ones if it has no others): coverage by number and by weight (country_code, weight), the weight
    that reports from the year `recent` on, the first year with enough countries, whether it has fewer than `few` different values, and whether any value is projected."""
    some = F.bool_or(~F.col("is_projection")).over(Window.partitionBy("indicator_code"))
    seen = rows.withColumn("some", some).filter(~F.col("some") | ~F.col("is_projection"))
    by_year = seen.groupBy("indicator_code", "year").agg(F.count_distinct("country_code").alias("n"))
    first = by_year.groupBy("indicator_code").agg(F.max("year").alias("latest_year"), F.min(F.when(F.col("n") >= least, F.col("year"))).alias("first_valid_year"))
    reporting = seen.groupBy("indicator_code", "country_code").agg(F.max("year").alias("last")).join(weights, "country_code", "left")
    covered = reporting.groupBy("indicator_code").agg(F.count("*").alias("countries"), (F.count("*") / n_countries).alias("coverage"), F.coalesce(F.sum("weight"), F.lit(0.0)).alias("weighted"), F.coalesce(F.sum(F.when(F.col("last") >= recent, F.col("weight"))), F.lit(0.0)).alias("weighted_recent"))
    values = seen.groupBy("indicator_code").agg((F.count_distinct("value") < few).alias("degenerate"))
    projected = rows.groupBy("indicator_code").agg(F.bool_or("is_projection").alias("has_projection"))
    return covered.join(first, "indicator_code").join(values, "indicator_code").join(projected, "indicator_code")


def basis_shares(nodes: DataFrame, components: DataFrame, by: str = "basis") -> DataFrame:
    """(gauge, value, share): the share of each gauge's nominal weight by a column of its components, such as the basis of their weights."""
    each = components.join(effective_weights(nodes).select(F.col("path").alias("leaf"), "effective"), "leaf").join(_gauge_of(nodes).withColumnRenamed("path", "leaf"), "leaf")
    sums = each.groupBy("gauge", F.col(by).alias("value")).agg(F.sum(F.col("effective") * F.col("weight")).alias("w"))
    return sums.select("gauge", "value", (F.col("w") / F.sum("w").over(Window.partitionBy("gauge"))).alias("share"))


def switches_by_alternative(chosen: DataFrame, targets: DataFrame) -> DataFrame:
    """(leaf, name, idx, country_years, switching, switching_targets): the country-years each alternative scores, beside how many countries, and how many of the targets (country_code), use several alternatives of the component."""
    by = chosen.groupBy("leaf", "name", "idx").agg(F.count("*").alias("country_years"))
    several = chosen.groupBy("leaf", "name", "country_code").agg((F.min("idx") < F.max("idx")).alias("several")).filter("several")
    several = several.join(targets.select("country_code", F.lit(1).alias("target")).distinct(), "country_code", "left")
    counts = several.groupBy("leaf", "name").agg(F.count("*").alias("switching"), F.count("target").alias("switching_targets"))
    return by.join(counts, ["leaf", "name"], "left").fillna(0, ["switching", "switching_targets"])


def tree_checks(nodes: DataFrame, components: DataFrame, alternatives: DataFrame, cites: DataFrame, sources: DataFrame, reasons: DataFrame, stated: DataFrame) -> DataFrame:
    """(check, item, value): what is wrong with a tree's tables, and how far its weights are from stated ones.

    Beside structure_checks: gaps whose reason isn't among reasons (reason), cites of unknown sources, and for each leaf of
    stated (leaf, name, weight; any scale) its largest difference and how many components are matched.
    """
    none = F.lit(None).cast("double")
    base = structure_checks(nodes, components, alternatives).withColumn("value", none)
    gaps = alternatives.filter("tier = 'gap'").join(reasons.select("reason").distinct(), "reason", "left_anti").select(F.lit("unknown reason").alias("check"), F.concat_ws("/", "leaf", "name", F.coalesce("reason", F.lit("?"))).alias("item"), none.alias("value"))
    unknown = cites.join(sources.select("id").distinct(), "id", "left_anti").select(F.lit("unknown source").alias("check"), F.concat_ws("/", "leaf", "name", F.col("id").cast("string")).alias("item"), none.alias("value"))
    share = stated.withColumn("share", F.col("weight") / F.sum("weight").over(Window.partitionBy("leaf"))).select("leaf", "name", "share")
    apart = share.join(components.select("leaf", "name", F.col("weight").alias("own")), ["leaf", "name"], "left").groupBy("leaf").agg(F.max(F.abs(F.col("own") - F.col("share"))).alias("apart"), F.count("own").cast("double").alias("matched"))
    weights = apart.select(F.explode(F.array(F.struct(F.lit("weight difference").alias("check"), F.col("leaf").alias("item"), F.col("apart").alias("value")), F.struct(F.lit("weights matched").alias("check"), F.col("leaf").alias("item"), F.col("matched").alias("value")))).alias("x")).select("x.*")
    return base.unionByName(gaps).unionByName(unknown).unionByName(weights)


def quality_view(scores: DataFrame, quality: DataFrame) -> DataFrame:
    """Leaf scores of the whole (path, year, country_code, score) beside those from intensity alone (leaf, .., quality), and their difference; null where there are none."""
    both = scores.join(quality.withColumnRenamed("leaf", "path"), ["path", "year", "country_code"], "left")
    return both.select("path", "year", "country_code", "score", "quality", (F.col("quality") - F.col("score")).alias("difference"))
