"""Secret scan with corpus-wide ownership frequencies, by DataFrame functions only.

Patterns propose candidates in every text.  The hashes of their values are counted over the whole
corpus by distinct repositories and owners: a value in the hands of several owners is a copied
example; one that a single owner has, and that looks random, is taken for a live credential.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .spans import matches, text_of, with_spans
from .sparkops import Scratch

#: Kinds in the order of ties: name, pattern (for Java), group of the value.
#: A run that begins right behind an equal character can't be a leftmost match, and every run's longest
#: match is the run, so the least length may stand in the pattern of the last two.
_VALUE = r"[A-Za-z0-9+/_.=-]+"
ASSIGN = rf"""(?=[PSTApsta])(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?({_VALUE})"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "live")
#: Owners from which on a value is an example.
EXAMPLE_OWNERS = 2
#: Values with at least this share of all candidates are joined by a broadcast (so many of them at most).
HOT = 1000
#: Words that mark a made-up value.
PLACEHOLDER = r"(?i)example|sample|dummy|change|placeholder|your|xxxx|0123456789abcdef|1234567890"


def _looks_live(value: Column) -> Column:
    """Random-looking: a digit and a letter, eight different characters, no placeholder word."""
    different = F.size(F.array_distinct(F.split(value, "")))
    return value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (different >= 8) & ~value.rlike(PLACEHOLDER)


def _kind(found: Column, number: int, value: Column | None = None) -> Column:
    def one(x: Column) -> Column:
        v = F.regexp_extract(x["v"], ASSIGN, 1) if number == 0 else x["v"]
        return F.struct(x["s"].alias("s"), F.lit(number).alias("k"), x["e"].alias("e"), F.length(v).alias("n"), F.sha2(v, 256).alias("hash"), _looks_live(v).alias("live"))

    return F.transform(found, one)


def candidates(docs: DataFrame, id_col: str, text_col: str, repo: Column, owner: Column) -> DataFrame:
    """(row, doc_id, repo, owner, spans) of every row; spans by start, then kind."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), repo.alias("repo"), owner.alias("owner"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    patterns = {"assign": ASSIGN, "access": ACCESS, "hex": HEX}
    rows = with_spans(rows.select("*", *(matches(F.col("text"), pattern).alias(name) for name, pattern in patterns.items())), "text", patterns)
    found = [_kind(F.col(name), i) for i, name in enumerate(patterns)]
    found[0] = F.filter(found[0], lambda x: x["n"] >= 12)
    return rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "repo", "owner", F.array_sort(F.concat(*found)).alias("spans"))


def ownership(spans: DataFrame) -> DataFrame:
    """(hash, n_rows, n_repos, n_owners) of every candidate value; null repositories and owners count as one each."""
    each = spans.select(F.explode("spans.hash").alias("hash"), F.coalesce("repo", F.lit("")).alias("repo"), F.coalesce("owner", F.lit("")).alias("owner"))
    by_repo = each.groupBy("hash", "owner", "repo").agg(F.count("*").alias("n"))
    return by_repo.groupBy("hash").agg(F.sum("n").alias("n_rows"), F.count_distinct("repo").alias("n_repos"), F.count_distinct("owner").alias("n_owners"))


def judged(spans: DataFrame, scratch: Scratch) -> DataFrame:
    """(row, x): every candidate with the ownership of its value.

    Values with a HOT-th of all candidates or more, HOT at most, are broadcast; the others are joined by their hash, so
    no task gets more of one value than that share.
    """
    frequent = scratch.store(ownership(spans), "ownership").select("hash", (F.col("n_owners") >= EXAMPLE_OWNERS).alias("example"), F.col("n_repos").cast("int").alias("repos"), "n_rows")
    total = frequent.agg(F.sum("n_rows")).first()[0] or 0
    hot = F.broadcast(frequent.filter(F.col("n_rows") * HOT >= total))
    each = spans.filter(F.size("spans") > 0).select("row", F.explode("spans").alias("x")).withColumn("hash", F.col("x.hash"))
    both = each.join(hot, "hash").unionByName(each.join(hot, "hash", "left_anti").join(frequent, "hash"))
    return both.select("row", F.struct("x.s", "x.k", "x.e", "x.n", "example", (F.col("x.live") & ~F.col("example")).alias("live"), "repos").alias("x"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo: Column | None = None, owner: Column | None = None) -> DataFrame:
    """One row per input row: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_example, live_repos.

    spans has the base spans and a span `live` for each value that one owner alone has and that looks
    random; live_repos is the largest number of repositories over which that owner has spread one of them (0 without any).
    By default the column source is the owner and source with lang the repository.
    A null or empty text has no spans; repeated rows and null ids stay; an empty table gives an
    empty result; other columns are ignored.
    """
    have = set(docs.columns)
    owner = owner if owner is not None else F.col("source") if "source" in have else F.lit(None).cast("string")
    repo = repo if repo is not None else F.concat_ws("/", owner, F.col("lang") if "lang" in have else F.lit(""))
    scratch = Scratch(docs.sparkSession, "secrets")
    spans = scratch.store(candidates(docs, id_col, text_col, repo, owner), "spans")
    rows = spans.select("row", "doc_id").join(judged(spans, scratch).groupBy("row").agg(F.array_sort(F.collect_list("x")).alias("x")), "row", "left")
    rows = rows.select("doc_id", F.coalesce("x", F.array().cast("array<struct<s:int,k:int,e:int,n:int,example:boolean,live:boolean,repos:int>>")).alias("x"))
    names = F.array(*map(F.lit, KINDS))

    def named(x: Column) -> Column:
        return F.struct(F.element_at(names, x["k"] + 1).alias("name"), x["s"].alias("s"), x["e"].alias("e"))

    x = F.col("x")
    live = F.transform(F.filter(x, lambda y: y["live"]), lambda y: F.struct((y["e"] - y["n"]).alias("s"), F.lit(3).alias("k"), y["e"].alias("e")))
    base = F.transform(x, lambda y: F.struct(y["s"].alias("s"), y["k"].alias("k"), y["e"].alias("e")))
    # an assigned value may be a hex value, too: equal neighbours in order are one
    rows = rows.withColumn("everything", F.array_sort(F.concat(base, live)))
    everything = F.filter("everything", lambda y, i: (i == 0) | (y != F.element_at("everything", F.greatest(i, F.lit(1)))))

    def count(k: int) -> Column:
        return F.size(F.filter(x, lambda y: y["k"] == k)).cast("long")

    return rows.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(text_of(F.transform(base, named)), 256).alias("base_sha256"), text_of(F.transform(everything, named)).alias("spans"),
        F.size(live).cast("long").alias("n_live"), F.size(F.filter(x, lambda y: y["example"])).cast("long").alias("n_example"),
        F.coalesce(F.array_max(F.transform(F.filter(x, lambda y: y["live"]), lambda y: y["repos"])), F.lit(0)).cast("long").alias("live_repos"),
    )
