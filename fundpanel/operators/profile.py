"""Structure of JSON payloads: what stands at which path, how list items are named, which shapes objects have.

A payload stays one row while it is walked: its nodes are an array that every step lengthens by one level, as many steps as the deepest
payload has levels (counted from its brackets in one scan).  Nothing is shuffled before the counts, which
shrink inside each task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fields that can name a list item, the first present one counts; a section and its part name it together.
NAMES = ("name_tag", "subsection_id", "id", "name", "key", "country_code", "code")
SECTION = ("id", "subsection_id")
#: Lists of metrics, whose items are all kept; of other lists a few of each shape are.
METRIC_LISTS = ("ratios", "financials", "fixed_income", "dividend", "zscore", "fund_and_profile", "summary", "commentary", "content", "children", "reports", "fields", "expenses_allocation", "10_year", "3_year", "5_year", "overall")

#: Kinds by the beginning of a variant's schema.
KINDS = {"OBJECT": "object", "ARRAY": "list", "STRING": "text", "BOOLEAN": "boolean", "VOID": "null", "BIGINT": "integer"}


def nesting(payload: Column) -> Column:
    """How many levels of brackets a JSON text has; brackets inside its strings don't count."""
    bare = F.regexp_replace(F.regexp_replace(payload, r'"(\\.|[^"\\])*"', ""), r"[^\[\]{}]", "")
    steps = F.transform(F.filter(F.split(bare, ""), lambda c: c != ""), lambda c: F.when(c.isin("[", "{"), 1).otherwise(-1))
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))
    deeper = lambda a, s: F.struct((a["now"] + s).alias("now"), F.greatest(a["most"], a["now"] + s).alias("most"))
    return F.aggregate(steps, start, deeper, lambda a: a["most"])


def _kind(value: str) -> str:
    stated = f"split(schema_of_variant({value}), '[<(]')[0]"
    return f"coalesce(element_at(map({', '.join(f"'{k}', '{v}'" for k, v in KINDS.items())}), {stated}), 'number')"


def _node(path: str, value: str, open_: str) -> str:
    return f"named_struct('path', {path}, 'kind', {_kind(value)}, 'v', {value}, 'open', {open_})"


def nodes(payloads: DataFrame, by: str = "url_prefix", text: str = "payload") -> DataFrame:
    """(by, nodes): for each readable payload its nodes (path, kind, v), from `$` down; `.key` leads into an object, `[]` to the items of a list.

    Payloads that aren't JSON, and null ones, are left out.  Kinds: object, list, text, integer, number, boolean, null.
    """
    rows = payloads.select(F.col(by).alias("by"), F.col(text).alias("text"), F.expr(f"try_parse_json(`{text}`)").alias("v")).filter("v IS NOT NULL")
    levels = rows.agg(F.max(nesting(F.col("text")))).first()[0] or 0
    rows = rows.select("by", F.expr(f"array({_node("'$'", 'v', 'true')})").alias("nodes"))
    itself = "array(named_struct('path', n.path, 'kind', n.kind, 'v', n.v, 'open', false))"
    fields = f"transform(map_entries(CAST(n.v AS map<string, variant>)), e -> {_node("concat(n.path, '.', e.key)", 'e.value', 'true')})"
    items = f"transform(CAST(n.v AS array<variant>), x -> {_node("concat(n.path, '[]')", 'x', 'true')})"
    step = f"flatten(transform(nodes, n -> CASE WHEN NOT n.open THEN array(n) WHEN n.kind = 'object' THEN concat({itself}, {fields}) WHEN n.kind = 'list' THEN concat({itself}, {items}) ELSE {itself} END))"
    for _ in range(levels):
        rows = rows.withColumn("nodes", F.expr(step))
    return rows.select(F.col("by").alias(by), F.expr("transform(nodes, n -> named_struct('path', n.path, 'kind', n.kind, 'v', n.v))").alias("nodes"))


def paths(walked: DataFrame, by: str = "url_prefix") -> DataFrame:
    """(by, path, kind, n_values, n_payloads, share): how often each kind stands at each path, and in what share of payloads."""
    total = walked.groupBy(by).agg(F.count("*").alias("total"))
    # a payload gives one row for each node, and one more for each different one
    key = lambda n, one: F.struct(n["path"].alias("path"), n["kind"].alias("kind"), F.lit(1 - one).alias("values"), F.lit(one).alias("payloads"))
    each = F.concat(F.transform("nodes", lambda n: key(n, 0)), F.array_distinct(F.transform("nodes", lambda n: key(n, 1))))
    counts = walked.select(by, F.inline(each)).groupBy(by, "path", "kind").agg(F.sum("values").alias("n_values"), F.sum("payloads").alias("n_payloads"))
    return counts.join(total, by).withColumn("share", F.col("n_payloads") / F.col("total")).drop("total")


def _field(name: str) -> Column:
    return F.expr(f"try_variant_get(v, '$.{name}', 'string')")


def items(walked: DataFrame, by: str = "url_prefix", names: Sequence[str] = NAMES, metric_lists: Sequence[str] = METRIC_LISTS) -> DataFrame:
    """(by, path, metric, identity, n): how list items that are objects are named, and how often each name stands.

    identity is `field:value` of the first field present, `section:id#part` where both are; null for items without one.
    metric marks the lists whose items are a closed set.
    """
    rows = walked.select(by, F.inline(F.filter("nodes", lambda n: (n["kind"] == "object") & n["path"].endswith("[]"))))
    section, part = (_field(n) for n in SECTION)
    both = F.when((part != "") & section.isNotNull(), F.concat(F.lit("section:"), section, F.lit("#"), part))
    identity = F.coalesce(both, *(F.concat(F.lit(f"{n}:"), _field(n)) for n in names))
    # the list's own key: the last one of its path
    metric = F.element_at(F.split(F.regexp_replace("path", r"(\[\])+$", ""), r"[.\[\]]+"), -1).isin(*metric_lists)
    return rows.select(by, "path", metric.alias("metric"), identity.alias("identity")).groupBy(by, "path", "metric", "identity").agg(F.count("*").alias("n"))


def shapes(walked: DataFrame, by: str = "url_prefix", samples: int = 3) -> DataFrame:
    """(by, path, shape, n, samples): the key sets of objects, and of each a few different texts.

    Texts fall into as many classes as samples are wanted, by their digest; a shape keeps the text of least digest
    of each class.  That is one aggregate, which holds so many texts of a shape and shrinks before the shuffle.
    """
    rows = walked.select(by, F.inline(F.filter("nodes", lambda n: n["kind"] == "object")))
    rows = rows.select(by, "path", F.array_join(F.array_sort(F.map_keys(F.expr("CAST(v AS map<string, variant>)"))), ",").alias("shape"), F.to_json("v").alias("text"))
    rows = rows.withColumn("digest", F.sha2("text", 256)).withColumn("class", F.pmod(F.conv(F.substring("digest", 1, 8), 16, 10).cast("long"), F.lit(samples)))
    least = [F.min(F.when(F.col("class") == i, F.struct("digest", "text"))) for i in range(samples)]
    found = rows.groupBy(by, "path", "shape").agg(F.count("*").alias("n"), F.array_compact(F.array(*least)).alias("least"))
    return found.select(by, "path", "shape", "n", F.transform(F.array_sort("least"), lambda x: x["text"]).alias("samples"))
