"""Nested payloads to observation rows.

Each extractor takes snapshots of one endpoint (snapshot_id, product_id, created_at, payload, currency) and returns
rows (snapshot_id, product_id, family, metric, code, effective_date, date_source_depth, fetched_at, value,
raw_value, ordinal, error).  A row with an error voids its snapshot (see run()); nothing raises inside a task.
All scalars are read as text, so that a number and its text are the same.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..functions import parsers as p
from ..sources.staging import stage
from .keyed import upsert_newer
from .profile import nesting

COLUMNS = ("snapshot_id", "product_id", "family", "metric", "code", "effective_date", "date_source_depth", "fetched_at", "value", "raw_value", "ordinal", "error")
_ITEM = "array<struct<name:string,weight:string,formatted_weight:string,country_code:string>>"
_TAG = "array<struct<name:string,name_tag:string,value:string,value_fmt:string>>"
SCHEMAS = {
    "holdings": f"as_of_date string, top_10_weight string, allocation_self {_ITEM}, investor_country {_ITEM}, industry {_ITEM}, debtor {_ITEM}, maturity {_ITEM}",
    "ratios": f"as_of_date string, ratios {_TAG}, financials {_TAG}, fixed_income {_TAG}, dividend {_TAG}, zscore {_TAG}",
    "profile": "expenses_allocation array<struct<name:string,value:string,ratio:string>>, fund_and_profile array<struct<name:string,name_tag:string,value:string>>, reports array<struct<name:string,as_of_date:string,fields:array<struct<name:string,value:string>>>>, mstar struct<x_axis_tag:array<string>,y_axis_tag:array<string>,x_axis:array<string>,y_axis:array<string>,selected:array<array<int>>,hist:array<array<int>>>",
    "esg": "asOfDate string, coverage string",
    "mstar": "as_of_date string, summary array<struct<id:string,value:string,publish_date:string>>",
    "lipper": "universes array<struct<name:string,as_of_date:string," + ",".join(f"`{h}`:array<struct<name_tag:string,rating:struct<name:string,value:string>>>" for h in vocab.LIPPER_HORIZONS) + ">>",
    "theme_weights": "coverage string, themes array<struct<key:string,name:string,weight:string,rank_adjusted_weight:string>>",
}


def parsed(snapshots: DataFrame, endpoint: str) -> DataFrame:
    """Snapshots with j, the payload by the endpoint's schema, and the snapshot's own day."""
    return snapshots.withColumn("j", F.from_json("payload", SCHEMAS[endpoint])).withColumn("day", F.to_date("created_at"))


def _scope(raw: Column, depth: int, date: Column | None = None, level: Column | None = None) -> tuple[Column, Column]:
    return p.scoped_date(p.parse_date(raw), depth, F.col("day") if date is None else date, F.lit(0) if level is None else level, F.col("day"))


def _rows(df: DataFrame, family: Column | str, metric: Column | str, value: Column, raw: Column, scope: tuple[Column, Column] | None = None, code: Column | None = None, ordinal: Column | int = 0, error: Column | None = None) -> DataFrame:
    """Observation rows of a frame; a row is kept if it has a finite value or an error.

    The row is laid out from an array of one struct, so that the test works on its fields and nothing is computed twice.
    """
    lit = lambda x: F.lit(x) if isinstance(x, str | int) else x
    date, depth = scope or (F.col("day"), F.lit(0))
    none = F.lit(None).cast("string")
    row = F.struct(
        lit(family).alias("family"), lit(metric).alias("metric"), (none if code is None else code).alias("code"), date.alias("effective_date"), depth.cast("int").alias("date_source_depth"), F.col("created_at").alias("fetched_at"),
        value.alias("value"), raw.alias("raw_value"), lit(ordinal).cast("long").alias("ordinal"), (none if error is None else error).alias("error"),
    )
    return df.select("snapshot_id", "product_id", F.inline(F.array(row))).filter(p.finite(F.col("value")) | F.col("error").isNotNull())


def _error(bad: Column, *text: Column | str) -> Column:
    return F.when(F.coalesce(bad, F.lit(False)), F.concat(*(F.lit(x) if isinstance(x, str) else F.coalesce(x, F.lit("?")) for x in text)))


def _numbered(items: Column, fields: Callable[[Column, Column], Sequence[Column]], kind: str) -> Column:
    """The items of a list as an array of structs of one type; a missing list has none."""
    return F.coalesce(F.transform(items, lambda x, i: F.struct(*fields(x, i))).cast(kind), F.array().cast(kind))


def _lookup(pairs: Mapping[str, str | None]) -> Column:
    return F.create_map(*[x for k, v in pairs.items() for x in (F.lit(k), F.lit(v).cast("string"))])


def _by(kind: Column, cases: Mapping[str, Column]) -> Column:
    """The case of a row's kind; null without one."""
    out = F.lit(None)
    for name, value in cases.items():
        out = F.when(kind == name, value).otherwise(out)
    return out


#: The sleeves of holdings: family -> list, members (whether each is residual), first ordinal.
SLEEVES = {
    "asset_class": ("allocation_self", vocab.ASSET_CLASS_METRICS, 1_000),
    "country": ("investor_country", None, 2_000),
    "industry": ("industry", vocab.INDUSTRY_METRICS, 3_000),
    "credit_rating": ("debtor", vocab.CREDIT_RATING_METRICS, 4_000),
    "maturity": ("maturity", vocab.MATURITY_METRICS, 5_000),
}


def holdings(snapshots: DataFrame) -> DataFrame:
    """The share of the ten largest, and sleeves: weights clipped at 0 and divided by their sum; then residual members go.

    All sleeves of a snapshot are one array, which is laid out once; a sleeve's sum is taken inside it, so nothing is shuffled.
    """
    df = parsed(snapshots, "holdings")
    weight = lambda x: x["weight"].try_cast("double")
    given = lambda items: F.filter(F.col(f"j.{items}"), lambda x: x["name"].isNotNull() & (x["name"] != "") & weight(x).isNotNull())
    top = F.array(F.struct(F.lit(None).alias("name"), F.col("j.top_10_weight").alias("weight"), F.lit(None).alias("formatted_weight"), F.lit(None).alias("country_code"))).cast(_ITEM)
    parts = [F.struct(F.lit("profile").alias("family"), F.lit(0).alias("base"), top.alias("given"))]
    parts += [F.struct(F.lit(family).alias("family"), F.lit(base).alias("base"), given(items).alias("given")) for family, (items, _, base) in SLEEVES.items()]
    scope = _scope(F.col("j.as_of_date"), 1)
    df = df.withColumns({"date": scope[0], "depth": scope[1]}).select("snapshot_id", "product_id", "created_at", "day", "date", "depth", F.inline(F.array(*parts)))
    share = lambda x: F.greatest(weight(x) / 100, F.lit(0.0))
    df = df.withColumn("total", F.aggregate("given", F.lit(0.0), lambda acc, x: acc + share(x)))
    df = df.select("snapshot_id", "product_id", "created_at", "day", "date", "depth", "family", "base", "total", F.posexplode("given").alias("i", "x"))
    family, name, raw = F.col("family"), F.col("x.name"), F.col("x.weight")
    renamed = F.coalesce(F.element_at(_lookup(vocab.INDUSTRY_NAME_REMAPS), name), name)
    df = df.withColumn("label", F.when(family == "profile", "top_10_weight").otherwise(p.snake_case(F.when(family == "industry", renamed).when(family == "credit_rating", p.credit_label(name)).otherwise(name))))
    label = F.col("label")
    member = _by(family, {f: label.isin(*members) for f, (_, members, _) in SLEEVES.items() if members is not None})
    residual = _by(family, {f: label.isin(*gone) for f, (_, members, _) in SLEEVES.items() if (gone := [k for k, r in (members or {}).items() if r] or (vocab.COUNTRY_RESIDUALS if f == "country" else ()))})
    sleeve = F.when((F.col("total") > 0) & ~F.coalesce(residual, F.lit(False)), share(F.col("x")) / F.col("total"))
    value = F.when(family == "profile", p.percentage(raw)).otherwise(sleeve)
    error = F.coalesce(_error((family == "profile") & p.percentage_error(raw), "bad percentage ", raw), _error(~member, "unknown ", family, " ", label))
    remapped = F.when(F.trim(name).isin(*vocab.COUNTRY_CODE_REMAPS), F.element_at(_lookup(vocab.COUNTRY_CODE_REMAPS), F.trim(name))).otherwise(F.col("x.country_code"))
    return _rows(df, family, label, value, F.coalesce("x.formatted_weight", raw), (F.col("date"), F.col("depth")), F.when(family == "country", remapped), F.col("i") + F.col("base"), error)


def ratios(snapshots: DataFrame) -> DataFrame:
    df = parsed(snapshots, "ratios")
    items = F.concat(*(F.coalesce(F.col(f"j.{s}"), F.array().cast(_TAG)) for s in ("dividend", "financials", "fixed_income", "ratios", "zscore")))
    rows = df.select("*", F.posexplode(items).alias("i", "x")).filter("x.value IS NOT NULL AND x.name_tag <> ''")
    metric, raw = p.snake_case(F.col("x.name_tag")), F.coalesce("x.value_fmt", "x.value")
    value = F.col("x.value").try_cast("double")
    skip = (metric == "average_quality") & (raw == "-")
    unknown = ~metric.isin(*vocab.RATIOS_PERCENTAGE_METRICS, *vocab.RATIOS_STANDARD_METRICS)
    error = F.coalesce(_error(unknown, "unknown ratio ", metric), _error(~skip & value.isNull(), "bad number ", F.col("x.value")))
    return _rows(rows, "ratios", metric, F.when(~skip, F.when(metric.isin(*vocab.RATIOS_PERCENTAGE_METRICS), value / 100).otherwise(value)), raw, _scope(F.col("j.as_of_date"), 1), ordinal=F.col("i"), error=error)


#: One item of a profile: an expense, a tag, a report's field or a style box's cell.
_PART = "array<struct<kind:string,ordinal:int,name:string,tag:string,value:string,ratio:string,title:string,as_of:string,cell:array<int>>>"
#: The tags and names of the profile's list that are read, and those that are passed over.
TAGS = {
    "redemption_charge_max": ("Redemption_Charge_Max", "Redemption Charge Max"),
    "redemption_charge_actual": ("Redemption_Charge_Actual", "Redemption Charge Actual"),
    "total_expense_ratio": ("Total_Expense_Ratio", "Total Expense Ratio"),
    "is_passive": ("Management_Approach", "Management Approach"),
    "total_net_assets_local": ("Total_Net_Assets_Month_End", "Total Net Assets"),
    "manager_tenure_years": ("Manager_Tenure", "Manager Tenure"),
}
PASSED_OVER = ("Inception_Date", "Maturity_Date", "Inception Date", "Maturity Date")


def _tag_metric(tag: Column, name: Column) -> Column:
    """The metric of a tag or name, the first that fits; net assets by the beginning of the name, charges by either spelling of the tag."""
    out = F.lit(None).cast("string")
    for metric, (a, b) in reversed(TAGS.items()):
        fits = (tag == a) | (name.startswith(b) if metric == "total_net_assets_local" else (name == b) | (tag == b if metric.startswith("redemption") else F.lit(False)))
        out = F.when(fits, metric).otherwise(out)
    return F.when(~tag.isin(*PASSED_OVER[:2]) & ~name.isin(*PASSED_OVER[2:]), out)


def profile(snapshots: DataFrame, known: Column | None = None) -> DataFrame:
    """Expenses, the tag list, report fees and the style box: all items of a snapshot are one array, laid out once."""
    known = F.array().cast("array<string>") if known is None else known
    df = parsed(snapshots, "profile")
    nothing = F.lit(None)
    item = lambda kind, ordinal, name=nothing, tag=nothing, value=nothing, ratio=nothing, title=nothing, as_of=nothing, cell=nothing: [c.alias(n) for c, n in zip((F.lit(kind), ordinal, name, tag, value, ratio, title, as_of, cell), ("kind", "ordinal", "name", "tag", "value", "ratio", "title", "as_of", "cell"), strict=True)]
    reports = F.flatten(F.transform("j.reports", lambda r, i: F.coalesce(F.transform(r["fields"], lambda x, k: F.struct(*item("report", 1_000 + i * 100 + k, x["name"], value=x["value"], title=r["name"], as_of=r["as_of_date"]))).cast(_PART), F.array().cast(_PART))))
    parts = [
        _numbered(F.col("j.expenses_allocation"), lambda x, i: item("expense", i, x["name"], value=x["value"], ratio=x["ratio"]), _PART),
        _numbered(F.col("j.fund_and_profile"), lambda x, i: item("tag", i + 100, x["name"], x["name_tag"], x["value"]), _PART),
        F.coalesce(reports, F.array().cast(_PART)),
        _cells("selected", "style_box"),
        _cells("hist", "style_box_hist"),
    ]
    axis = lambda name: F.transform(F.coalesce(f"j.mstar.{name}_axis_tag", f"j.mstar.{name}_axis", F.array().cast("array<string>")), lambda t: F.lower(F.trim(t)))
    df = df.withColumns({"xs": axis("x"), "ys": axis("y")})
    rows = df.select("snapshot_id", "product_id", "created_at", "day", "currency", "xs", "ys", F.inline(F.concat(*parts)))
    kind, name, v = F.col("kind"), F.col("name"), F.col("value")
    fee = _by(F.col("title"), {title: F.element_at(_lookup(fields), name) for title, fields in (("Annual Report", vocab.ANNUAL_REPORT_METRICS), ("Prospectus Report", vocab.PROSPECTUS_REPORT_METRICS))})
    expense = F.when(name == "Management Expenses", "management_expense_ratio").when(name == "Non-Management Expenses", "non_management_expense_ratio")
    a, b = F.get("cell", F.lit(0)), F.get("cell", F.lit(1))
    style = F.when(kind.startswith("style_box"), F.coalesce(F.concat_ws("_", F.get("ys", b), F.get("xs", a)), F.lit("")))
    metric = _by(kind, {"expense": expense, "tag": F.when(v.isNotNull(), _tag_metric(F.coalesce("tag", F.lit("")), F.coalesce("name", F.lit("")))), "report": fee})
    rows = rows.withColumn("metric", F.coalesce(metric.cast("string"), style)).filter("metric IS NOT NULL")
    m = F.col("metric")
    bad_axes = (F.size("xs") == 0) | (F.size("ys") == 0) | (F.size(F.array_except("xs", F.array(*map(F.lit, vocab.STYLE_STYLES)))) > 0) | (F.size(F.array_except("ys", F.array(*map(F.lit, vocab.STYLE_SIZES)))) > 0)
    bad_box = kind.startswith("style_box") & (bad_axes | (F.size("cell") < 2) | a.isNull() | b.isNull() | (a < 0) | (b < 0) | (a >= F.size("xs")) | (b >= F.size("ys")))
    approach = F.lower(F.trim(v))
    skip = approach.isin(*vocab.SKIP_RATING_TOKENS)
    amount, fees = _scope(p.embedded_date(v), 3), _scope(F.col("as_of"), 2)
    # what several kinds of items read, each once
    rows = rows.withColumns({
        "share": p.percentage(v), "bad_share": p.percentage_error(v), "of": p.amount_currency(v, F.col("currency"), known), "assets": p.net_assets(v), "tenure": p.manager_tenure(v, F.col("day")), "bad_tenure": p.tenure_error(v),
        "amount_date": amount[0], "amount_depth": amount[1], "fee_date": fees[0], "fee_depth": fees[1], "bad_box": F.coalesce(bad_box, F.lit(True)),
    })
    as_percentage = (kind == "report") | m.isin("redemption_charge_max", "redemption_charge_actual", "total_expense_ratio")
    value = (
        F.when(kind.startswith("style_box"), F.when(~F.col("bad_box"), 1.0))
        .when(kind == "expense", F.col("ratio").try_cast("double"))
        .when(as_percentage, F.col("share"))
        .when(m == "is_passive", F.when(approach == "passive", 1.0).when(approach == "active", 0.0))
        .when(m == "total_net_assets_local", F.when(F.col("of").isNotNull(), F.col("assets")))
        .when(m == "manager_tenure_years", F.col("tenure"))
    )
    error = F.coalesce(
        _error(F.col("bad_box"), "bad style box"), _error((kind != "expense") & as_percentage & F.col("bad_share"), "bad percentage ", v),
        _error((m == "is_passive") & ~skip & ~approach.isin("passive", "active"), "unknown approach ", v), _error((m == "manager_tenure_years") & F.col("bad_tenure"), "bad tenure ", v),
    )
    date = F.when(m == "total_net_assets_local", F.col("amount_date")).when(kind == "report", F.col("fee_date")).otherwise(F.col("day"))
    depth = F.when(m == "total_net_assets_local", F.col("amount_depth")).when(kind == "report", F.col("fee_depth")).otherwise(0)
    raw = F.when(kind == "expense", F.coalesce(v, F.col("ratio"))).when(kind.startswith("style_box"), F.concat(F.lit("["), F.array_join(F.col("cell").cast("array<string>"), ", "), F.lit("]"))).otherwise(F.trim(v))
    family = F.when(kind.startswith("style_box"), kind).otherwise("profile")
    return _rows(rows, family, m, value, raw, (date, depth), F.when(m == "total_net_assets_local", F.col("of")), F.col("ordinal"), error)


def _cells(field: str, family: str) -> Column:
    """The cells of a style box as items."""
    none = lambda n: F.lit(None).alias(n)
    return _numbered(F.col(f"j.mstar.{field}"), lambda c, i: [F.lit(family).alias("kind"), (i + 10_000).alias("ordinal"), *map(none, ("name", "tag", "value", "ratio", "title", "as_of")), c.alias("cell")], _PART)


def esg(snapshots: DataFrame) -> DataFrame:
    """The coverage and every node of the score tree at any depth, parents before their children.

    A snapshot's nodes are one array, which each step lengthens by a level, as many steps as the deepest payload has.
    """
    df = parsed(snapshots, "esg").withColumn("v", F.expr("try_parse_json(payload)"))
    levels = (df.agg(F.max(nesting(F.col("payload")))).first()[0] or 0) // 2
    scope = _scope(F.col("j.asOfDate"), 1)
    children = lambda nodes, path: f"transform(coalesce(try_variant_get({nodes}, 'array<variant>'), array()), (c, k) -> named_struct('path', concat({path}, array(k)), 'node', c, 'open', true))"
    df = df.withColumn("nodes", F.expr(children("v, '$.content'", "cast(array() as array<int>)")))
    for _ in range(levels):
        below = children("n.node, '$.children'", "n.path")
        df = df.withColumn("nodes", F.expr(f"flatten(transform(nodes, n -> CASE WHEN n.open THEN concat(array(named_struct('path', n.path, 'node', n.node, 'open', false)), {below}) ELSE array(n) END))"))
    cover = F.array(F.struct(F.lit(0).alias("i"), F.lit("profile").alias("family"), F.lit("esg_coverage").alias("name"), F.col("j.coverage").alias("value")))
    read = "array_sort(transform(nodes, n -> named_struct('path', n.path, 'name', try_variant_get(n.node, '$.name', 'string'), 'value', try_variant_get(n.node, '$.value', 'string'))), (a, b) -> CASE WHEN a.path < b.path THEN -1 WHEN a.path > b.path THEN 1 ELSE 0 END)"
    each = F.transform(F.expr(read), lambda n, i: F.struct((i + 1).alias("i"), F.lit("esg").alias("family"), n["name"].alias("name"), n["value"].alias("value")))
    rows = df.withColumns({"date": scope[0], "depth": scope[1]}).select("snapshot_id", "product_id", "created_at", "day", "date", "depth", F.inline(F.concat(cover, each)))
    rows = rows.filter("i = 0 OR name <> '' AND value IS NOT NULL")
    tree, value = F.col("i") > 0, F.col("value").try_cast("double")
    metric = F.when(tree, p.snake_case(F.col("name"))).otherwise(F.col("name"))
    error = F.coalesce(_error(tree & ~metric.isin(*vocab.ESG_METRICS), "unknown esg ", metric), _error(tree & value.isNull(), "bad number ", F.col("value")))
    return _rows(rows, F.col("family"), metric, value, F.col("value"), (F.col("date"), F.col("depth")), ordinal=F.col("i"), error=error)


def mstar(snapshots: DataFrame) -> DataFrame:
    """Pillar coverage and ratings as numbers: the coverage is an item before the pillars."""
    df = parsed(snapshots, "mstar")

    def base(i: Column) -> Column:
        key = F.regexp_replace(F.lower(F.trim(i)), "^q_", "")
        return F.when(key == "quantitative_rating", "medalist_rating").otherwise(key)

    outer = _scope(F.col("j.as_of_date"), 1)
    n = F.size(F.filter("j.summary", lambda x: base(x["id"]).isin("people", "process", "parent")))
    missing = F.exists("j.summary", lambda x: F.coalesce(x["id"], F.lit("")) == "")
    kind = "array<struct<i:int,id:string,value:string,publish_date:string>>"
    cover = F.array(F.struct(F.lit(0), F.lit(None), F.lit(None), F.lit(None))).cast(kind)
    pillars = _numbered(F.col("j.summary"), lambda x, i: [(i + 1).alias("i"), x["id"].alias("id"), x["value"].alias("value"), x["publish_date"].alias("publish_date")], kind)
    df = df.withColumns({"n": n, "missing": missing, "date": outer[0], "depth": outer[1]})
    rows = df.select("snapshot_id", "product_id", "created_at", "day", "n", "missing", "date", "depth", F.inline(F.concat(cover, pillars)))
    rows = rows.withColumn("m", base(F.col("id"))).withColumn("v", F.trim("value"))
    rows = rows.filter((F.col("i") == 0) | ~F.lower(F.trim("id")).isin("category", "category_index") & F.col("v").isNotNull() & ~F.lower("v").isin(*vocab.SKIP_RATING_TOKENS))
    first = F.col("i") == 0
    score = _by(F.col("m"), {metric: F.element_at(F.create_map(*[F.lit(x) for pair in vocab.RATINGS[scale].items() for x in pair]), F.lower("v")) for metric, scale in vocab.PILLAR_KINDS.items()})
    error = F.coalesce(_error(first & F.col("missing"), "a pillar has no id"), _error(~first & ~F.col("m").isin(*vocab.PILLAR_KINDS), "unknown pillar ", F.col("id")), _error(~first & score.isNull(), "unknown rating ", F.col("v")))
    own = _scope(F.col("publish_date"), 3, F.col("date"), F.col("depth"))
    pick = lambda a, b: F.when(first, a).otherwise(b)
    return _rows(
        rows, pick(F.lit("profile"), F.lit("mstar")), pick(F.lit("mstar_coverage"), F.col("m")), pick(F.when(F.col("n") > 0, F.col("n") / 3.0), score.cast("double")), pick(F.concat(F.col("n").cast("string"), F.lit("/3 pillars")), F.col("v")),
        (pick(F.col("date"), own[0]), pick(F.col("depth"), own[1])), ordinal=F.col("i"), error=error,
    )


def lipper(snapshots: DataFrame) -> DataFrame:
    """Scores of one universe per payload: the most peers, then the order of countries, then the first; all horizons are one array."""
    df = parsed(snapshots, "lipper")

    def peers(u: Column) -> Column:
        lists = F.concat(*(F.coalesce(u[h], F.array()) for h in vocab.LIPPER_HORIZONS))
        return F.coalesce(F.array_max(F.transform(lists, lambda x: p.largest_integer(F.coalesce(x["rating"]["name"], F.lit(""))))), F.lit(0).cast("bigint"))

    tie = F.create_map(*[F.lit(x) for i, c in enumerate(vocab.LIPPER_TIEBREAK) for x in (c, -i)])
    ranked = F.transform("j.universes", lambda u, i: F.struct(peers(u).alias("n"), F.coalesce(F.element_at(tie, F.coalesce(u["name"], F.lit(""))), F.lit(-len(vocab.LIPPER_TIEBREAK))).alias("tie"), (-i).alias("i")))
    rows = df.withColumn("best", F.array_max(ranked)).filter("best IS NOT NULL").withColumn("u", F.get("j.universes", -F.col("best.i")))
    kind = "array<struct<ordinal:int,suffix:string,tag:string,peers:string,value:string>>"
    parts = [_scores(horizon, suffix, at, kind) for at, (horizon, suffix) in enumerate(vocab.LIPPER_HORIZONS.items())]
    each = rows.select("snapshot_id", "product_id", "created_at", "day", "best", F.col("u.name").alias("universe"), F.col("u.as_of_date").alias("as_of"), F.inline(F.concat(*parts))).filter("tag <> '' AND value IS NOT NULL")
    count = F.coalesce(F.nullif(p.largest_integer(F.coalesce("peers", F.lit(""))), F.lit(0).cast("bigint")), F.col("best.n"))
    raw = F.concat("value", F.lit(" ("), F.coalesce(F.nullif("universe", F.lit("")), F.lit("global")), F.lit(": "), count.cast("string"), F.lit(" funds)"))
    return _rows(each, "lipper", F.concat(p.snake_case(F.col("tag")), F.lit("_"), F.col("suffix")), F.col("value").try_cast("double"), raw, _scope(F.col("as_of"), 2), ordinal=F.col("ordinal"))


def _scores(horizon: str, suffix: str, at: int, kind: str) -> Column:
    """The scores of one horizon as items."""
    return _numbered(F.col(f"u.{horizon}"), lambda x, i: [(i + 1_000 * at).alias("ordinal"), F.lit(suffix).alias("suffix"), x["name_tag"].alias("tag"), x["rating"]["name"].alias("peers"), x["rating"]["value"].alias("value")], kind)


def theme_weights(snapshots: DataFrame) -> DataFrame:
    """Coverage, and each theme's weight and rank-adjusted weight under its key, as one array."""
    df = parsed(snapshots, "theme_weights")
    kind = "array<struct<ordinal:int,family:string,key:string,name:string,value:string>>"
    cover = F.array(F.struct(F.lit(0), F.lit("profile"), F.lit(None), F.lit(None), F.col("j.coverage"))).cast(kind)
    both = F.flatten(F.transform("j.themes", lambda x, i: F.array(*(F.struct((i * 2 + k + 1).alias("ordinal"), F.lit(family).alias("family"), x["key"].alias("key"), x["name"].alias("name"), x[field].alias("value")) for k, (family, field) in enumerate((("theme", "weight"), ("rank_adj_theme", "rank_adjusted_weight")))))))
    rows = df.select("snapshot_id", "product_id", "created_at", "day", F.inline(F.concat(cover, F.coalesce(both.cast(kind), F.array().cast(kind))))).filter("ordinal = 0 OR key <> '' AND name <> ''")
    metric = F.when(F.col("ordinal") == 0, "theme_coverage").otherwise(p.snake_case(F.col("name")))
    return _rows(rows, F.col("family"), metric, F.col("value").try_cast("double"), F.col("value"), code=F.trim("key"), ordinal=F.col("ordinal"))


EXTRACTORS: dict[str, Callable[..., DataFrame]] = {"holdings": holdings, "ratios": ratios, "profile": profile, "esg": esg, "mstar": mstar, "lipper": lipper, "theme_weights": theme_weights}


def known_currencies(contracts: DataFrame) -> list[str]:
    """The different currencies of the contracts: at most a few hundred codes."""
    return sorted(r.currency for r in contracts.filter("currency IS NOT NULL").select("currency").distinct().collect())


def pending(snapshots: DataFrame, processed: DataFrame) -> DataFrame:
    """Snapshots without a watermark."""
    return snapshots.join(processed.select("snapshot_id"), "snapshot_id", "left_anti")


def check_routes(snapshots: DataFrame, routes: Mapping[str, str]) -> None:
    """Raises if a snapshot's prefix has no endpoint."""
    unknown = snapshots.filter(~F.col("url_prefix").isin(*routes)).select("url_prefix").distinct().limit(5).collect()
    if unknown:
        raise ValueError(f"unknown endpoints: {[r.url_prefix for r in unknown]}")


def run(snapshots: DataFrame, payloads: DataFrame, contracts: DataFrame, processed: DataFrame, routes: Mapping[str, str], known: Sequence[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(observations, failures, watermarks) of all pending snapshots.

    routes: url prefix -> endpoint; landing and empty payloads are watermarked without rows.  A missing or unreadable
    payload, or any error in a row, voids its snapshot and no other; it isn't watermarked.
    """
    todo = pending(snapshots, processed)
    check_routes(todo, routes)
    todo = stage(todo.join(payloads.select("hash", "payload"), "hash", "left").join(contracts.select("product_id", "currency"), "product_id", "left"))
    broken = F.col("payload").isNull() | F.expr("try_parse_json(payload)").isNull()
    failed = todo.filter(broken).select("snapshot_id", F.lit("missing or unreadable payload").alias("error"))
    todo = todo.filter(~broken)
    sets = F.array(*map(F.lit, known)).cast("array<string>")
    rows = []
    for endpoint, extract in EXTRACTORS.items():
        part = todo.filter(F.col("url_prefix").isin(*[u for u, e in routes.items() if e == endpoint]))
        rows.append(profile(part, sets) if endpoint == "profile" else extract(part))
    every = stage(reduce(DataFrame.unionByName, rows))
    failed = stage(failed.unionByName(every.filter("error IS NOT NULL").groupBy("snapshot_id").agg(F.min("error").alias("error"))))
    good = every.join(failed.select("snapshot_id"), "snapshot_id", "left_anti").drop("error")
    done = todo.select("snapshot_id").join(failed.select("snapshot_id"), "snapshot_id", "left_anti")
    return good, failed, done


KEY = ("product_id", "family", "metric", "effective_date")


def merge_observations(stored: DataFrame, good: DataFrame) -> DataFrame:
    """Stored observations with new ones where those come from a deeper date, or equally deep and later; ties keep the stored, else the first."""
    return upsert_newer(stored, good, KEY, ("date_source_depth", "fetched_at"), ("snapshot_id", "ordinal"))


def telemetry(snapshots: DataFrame, good: DataFrame, failed: DataFrame, done: DataFrame) -> DataFrame:
    """One row: pending, watermarked, failed and empty snapshots, and observations."""
    some = good.select("snapshot_id").distinct().withColumn("some", F.lit(True))
    a = done.join(some, "snapshot_id", "left").agg(F.count("*").alias("watermarked"), F.count_if(F.col("some").isNull()).alias("empty"))
    b = failed.select("snapshot_id").distinct().agg(F.count("*").alias("failed"))
    return snapshots.agg(F.count("*").alias("pending")).join(a, how="cross").join(b, how="cross").join(good.agg(F.count("*").alias("n_observations")), how="cross")
