"""Line dedup: repeated runs of lines over the whole corpus, by prefix doubling, with DataFrame functions only.

Every line of every text starts a suffix of lines.  Suffixes are ranked by their first 2, 4, 8, ..
lines: a round takes the pair of ranks at a line and so many lines on, sorts the different pairs by range
and numbers them in that order, so ranks order the suffixes as a suffix array does.  Suffixes of
equal rank are an interval whose common prefix is at least the rank's length; only intervals of two suffixes
or more go on, and rounds follow until none is left.

In an interval the first suffix stays; each other one is a later copy.  The longest prefix that it shares with any earlier
suffix comes from the ranks of all rounds, from the longest down: intervals are split by the rank of what follows, and each
part's first suffix stands for the part among the others.  Those lines are deleted; a run is maximal if no other of its text contains it.

A single line is a run of its own when it has PASSAGE words or more: its later copies are deleted, too,
whatever stands around them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sparkops import Scratch, in_struct, maybe_among

_KEY = ["d", "h"]
_PLACE = [*_KEY, "pos"]
#: Words (runs of non-white-space) from which on a single line is a passage.
PASSAGE = 20
_SPACE = r"\x20\x09-\x0D"


def adjacent(rows: DataFrame) -> DataFrame:
    """(d, h, pos, r, q): the ids of each line and the next, once for rows that repeat.  rows: (d, h, lines)."""
    ids = F.transform(F.col("lines"), lambda x: F.xxhash64(x))
    once = rows.filter(F.size("lines") > 1).select(*_KEY, ids.alias("ids")).groupBy(*_KEY).agg(F.first("ids").alias("ids"))
    both = F.arrays_zip(F.expr("slice(ids, 1, size(ids) - 1)").alias("r"), F.expr("slice(ids, 2, size(ids) - 1)").alias("q"))
    return once.select(*_KEY, F.posexplode(both).alias("pos", "x")).select(*_PLACE, "x.r", "x.q")


def _ranked(pairs: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(d, h, pos, rank, first): the suffixes whose pair of ranks (r, q) another one has, too, numbered in sort order, and the first place of each interval."""
    found = pairs.groupBy("r", "q").agg(F.count("*").alias("n"), F.min(F.struct(*_PLACE)).alias("first")).filter("n > 1")
    ranks = found.repartitionByRange("r", "q").sortWithinPartitions("r", "q").select("r", "q", F.monotonically_increasing_id().alias("rank"), "first")
    out = scratch.store(pairs.join(scratch.store(ranks, f"{name}-ranks"), ["r", "q"]).select(*_PLACE, "rank", "first"), name)
    scratch.drop(f"{name}-ranks")
    return out


def _on(level: DataFrame, step: int) -> DataFrame:
    """(d, h, pos, r, q): the rank at a line and the one step lines on; none where that is in no interval."""
    later = F.first("rank").over(Window.partitionBy(*_KEY).orderBy("pos").rangeBetween(step, step))
    return level.select(*_PLACE, F.col("rank").alias("r"), later.alias("q")).filter("q is not null")


def double(rows: DataFrame, scratch: Scratch) -> list[tuple[int, DataFrame]]:
    """The rounds of the doubling: (length, suffixes of equal prefixes of that length), until all intervals are single."""
    levels, length, pairs = [], 2, adjacent(rows)
    while True:
        level = _ranked(pairs, scratch, f"level{length}")
        if not level.limit(1).count():
            return levels
        levels.append((length, level))
        pairs = _on(level, length)
        length *= 2


def _beside(state: DataFrame) -> DataFrame:
    """state without groups of one member."""
    return state.join(state.groupBy("g").agg(F.count("*").alias("m")).filter("m > 1").select("g"), "g", "left_semi")


def _split(state: DataFrame, level: DataFrame, at: Column, by: int) -> DataFrame:
    """The groups of state (g, place, n), parted by the rank at the place `at` lines on.

    Members that share that rank are a group of their own, `by` lines longer; the first of each part stays in the old group, too,
    where it stands for all of its part: what the others have in common with later parts, it has.  So each member but the
    first of a group is in one group that it isn't first of, and there are fewer rows than twice those.
    """
    ranks = level.select(*_KEY, F.col("pos").alias("at"), F.col("rank").alias("r"))
    parted = state.withColumn("at", F.col("pos") + at).join(ranks, [*_KEY, "at"], "left")
    parts = parted.filter("r is not null").groupBy("g", "r").agg(F.min(F.struct(*_PLACE, "n")).alias("x"), F.count("*").alias("m"))
    longer = parted.filter("r is not null").join(parts.filter("m > 1").select("g", "r"), ["g", "r"], "left_semi").select(F.xxhash64("g", F.lit(by), "r").alias("g"), *_PLACE, (F.col("n") + by).alias("n"))
    firsts = parts.select("g", "x.*").select("g", *_PLACE, "n").unionByName(parted.filter("r is null").select("g", *_PLACE, "n"))
    return longer.unionByName(_beside(firsts))


def later_runs(rows: DataFrame, min_lines: int, scratch: Scratch) -> DataFrame:
    """(d, h, pos, n): each place where a run of min_lines lines or more begins that has an earlier copy, and the most lines it has in common with any earlier place.

    Of the longest prefix that a place isn't the first to have, a round knows the power of two: its interval splits in the next round into
    parts that it is the first of.  The lines beyond are found from the ranks of shorter rounds, the longest first.
    """
    levels = double(rows, scratch)
    if not levels:
        return rows.select(*_KEY, F.lit(0).alias("pos"), F.lit(0).alias("n")).limit(0)
    state = None
    for i in range(len(levels) - 1, -1, -1):
        length, level = levels[i]
        # of the interval's parts in the next round only the first places
        again = [] if i + 1 == len(levels) else [levels[i + 1][1].filter(F.struct(*_PLACE) > F.col("first")).select(*_PLACE)]
        fresh = level.select(F.xxhash64(F.lit(length), "rank").alias("g"), *_PLACE, F.lit(length).alias("n"))
        for later in again:
            fresh = _beside(fresh.join(later, _PLACE, "left_anti"))
        # stored each time: many small plans instead of a large one
        state = scratch.store(fresh if state is None else _split(state, level, F.col("n"), length).unionByName(fresh), f"state{i}")
        scratch.drop(f"state{i + 1}")
    # an odd line at the end: the pair that ends with it
    state = scratch.store(_split(state, levels[0][1], F.col("n") - 1, 1), "state")
    scratch.drop("state0")
    first = state.groupBy("g").agg(F.min(F.struct(*_PLACE)).alias("first"))
    return state.join(first, "g").filter(F.struct(*_PLACE) > F.col("first")).select(*_PLACE, "n").filter(F.col("n") >= min_lines)


def later_windows(rows: DataFrame, min_lines: int, scratch: Scratch) -> DataFrame:
    """(d, h, pos, n): the places that aren't the first of their interval, in each round of min_lines lines or more, with the round's length.

    Together they cover what later_runs() covers, as all windows of a run are later copies if the run is; how long a run is needn't be known.
    """
    levels = double(rows, scratch)
    wanted = [x for x in levels if x[0] >= min_lines]
    below = [x for x in levels if x[0] < min_lines]
    if below and min_lines & (min_lines - 1) and 2 * below[-1][0] > min_lines:
        length, level = below[-1]
        wanted.append((min_lines, _ranked(_on(level, min_lines - length), scratch, "wanted")))
    none = rows.select(*_KEY, F.lit(0).alias("pos"), F.lit(0).alias("n")).limit(0)
    for length, level in wanted:
        none = none.unionByName(level.filter(F.struct(*_PLACE) > F.col("first")).select(*_PLACE, F.lit(length).alias("n")))
    return none


def later_passages(rows: DataFrame, words: int, scratch: Scratch) -> DataFrame:
    """(d, h, pos, n): the lines of so many words or more that stand at an earlier place, too; n is 1.  rows: (d, h, lines)."""
    # possessive, and no further than the last word needed; only ids of long lines are shuffled
    long = F.col("line").rlike(rf"^[{_SPACE}]*+(?:[^{_SPACE}]++[{_SPACE}]++){{{words - 1}}}[^{_SPACE}]")
    each = rows.select(*_KEY, F.posexplode("lines").alias("pos", "line")).filter(long).select(*_PLACE, F.xxhash64("line").alias("r"))
    repeated = each.groupBy("r").agg(F.min(F.struct(*_PLACE)).alias("first"), F.max(F.struct(*_PLACE)).alias("last")).filter("first < last")
    # equal rows (id, text) give the same places
    return each.join(scratch.store(repeated.select("r", "first"), "passages"), "r").filter(F.struct(*_PLACE) > F.col("first")).select(*_PLACE, F.lit(1).alias("n"))


def maximal(runs: DataFrame) -> DataFrame:
    """(d, h, runs): of each text the runs that no other one contains, in order: array of (pos, n, new), new the first line that no run before has."""
    end = F.col("pos") + F.col("n")
    before = F.max(end).over(Window.partitionBy(*_KEY).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1))
    each = runs.groupBy(*_PLACE).agg(F.max("n").alias("n")).withColumn("before", F.coalesce(before, F.lit(0))).filter(end > F.col("before"))
    return each.groupBy(*_KEY).agg(F.array_sort(F.collect_list(F.struct("pos", "n", F.greatest("pos", "before").alias("new")))).alias("runs"))


def joined(windows: DataFrame) -> DataFrame:
    """(d, h, runs): of each text its windows as stretches that don't touch, in the shape of maximal()."""
    by_place = Window.partitionBy(*_KEY).orderBy("pos")
    before = F.max(F.col("pos") + F.col("n")).over(by_place.rowsBetween(Window.unboundedPreceding, -1))
    each = windows.groupBy(*_PLACE).agg(F.max("n").alias("n")).withColumn("apart", (F.col("pos") > F.coalesce(before, F.lit(-1))).cast("int"))
    parts = each.withColumn("part", F.sum("apart").over(by_place)).groupBy(*_KEY, "part").agg(F.min("pos").alias("pos"), F.max(F.col("pos") + F.col("n")).alias("end"))
    return parts.groupBy(*_KEY).agg(F.array_sort(F.collect_list(F.struct("pos", (F.col("end") - F.col("pos")).alias("n"), F.col("pos").alias("new")))).alias("runs"))


def cut_lines(docs: DataFrame, id_col: str, text_col: str, min_lines: int, passage: int, runs_wanted: bool = True) -> DataFrame:
    """(row, text, n_lines, n_deleted, runs): the caller's row and its text without later copies; see dedup_lines().

    Where the maximal runs aren't wanted, runs are the deleted stretches, and their lengths aren't looked for.
    """
    if min_lines < 2:
        raise ValueError("a run has two lines at least; single lines are passages")
    scratch = Scratch(docs.sparkSession, "lines")
    text = F.col(f"`{text_col}`")
    d = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(-(2**63)))
    h = F.xxhash64(F.coalesce(text, F.lit("")))
    rows = docs.filter(text.isNotNull()).select(d.alias("d"), h.alias("h"), F.split(text, "\n", -1).alias("lines"))
    runs = (later_runs if runs_wanted else later_windows)(rows, min_lines, scratch).unionByName(later_passages(rows, passage, scratch))
    gone = scratch.store((maximal if runs_wanted else joined)(runs), "gone")
    scratch.drop(*(x for x in scratch.paths if x != "gone"))
    marked = maybe_among(in_struct(docs, d=d, h=h), gone, *_KEY)
    body = F.col("row").getField(text_col)
    # a text without deletions isn't shuffled; what the lambdas below read are columns of the join, not expressions to evaluate again
    touched = marked.filter("maybe").select("row", *_KEY, F.split(body, "\n", -1).alias("lines")).join(gone.hint("merge"), _KEY, "left")
    starts = F.concat(F.array(F.lit(0)), F.transform("runs", lambda x: x["pos"] + x["n"]))
    ends = F.concat(F.transform("runs", lambda x: x["new"]), F.array(F.size("lines")))
    kept = F.filter(F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("a"), (b - a).alias("n"))), lambda x: x["n"] > 0)
    left = F.array_join(F.flatten(F.transform(kept, lambda x: F.slice("lines", x["a"] + 1, x["n"]))), "\n")
    deleted = F.aggregate("runs", F.lit(0), lambda acc, x: acc + x["pos"] + x["n"] - x["new"])
    named = F.array_join(F.transform("runs", lambda x: F.concat_ws(":", x["pos"].cast("string"), x["n"].cast("string"))), ",")
    none = F.col("runs").isNull()
    touched = touched.select("row", F.when(none, body).otherwise(left).alias("text"), F.when(body.isNull(), 0).otherwise(F.size("lines")).cast("long").alias("n_lines"), F.when(none, 0).otherwise(deleted).cast("long").alias("n_deleted"), F.when(none, "").otherwise(named).alias("runs"))
    n_lines = F.when(body.isNull(), 0).otherwise(F.length(body) - F.length(F.replace(body, F.lit("\n"), F.lit(""))) + 1)
    rest = marked.filter("NOT maybe").select("row", body.alias("text"), n_lines.cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_deleted"), F.lit("").alias("runs"))
    return touched.unionByName(rest)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_lines: int = 2, passage: int = PASSAGE) -> DataFrame:
    """docs, all columns, with later copies of runs of min_lines lines or more, and of lines of passage words or more, deleted from the text.

    Adds n_lines, n_deleted and runs (start:length of each maximal run, counted in lines from 0; runs may overlap);
    columns of these names in docs are replaced.
    Lines are what line feeds separate.  The earlier place is that with the smaller id, then the smaller
    hash of the text, then the smaller line number; the first copy of any line always stays.  A null text
    stays null without lines; an empty one is one empty line.  Rows with equal id and text are treated alike, and
    null ids come before all others.  A text with nothing left becomes empty.  An empty table gives an empty result.
    """
    added = ["n_lines", "n_deleted", "runs"]
    cut = cut_lines(docs, id_col, text_col, min_lines, passage)
    own = [F.col("text").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns if c not in added]
    return cut.select(*own, *added)


def without_later_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars", min_lines: int = 2, passage: int = PASSAGE) -> DataFrame:
    """docs, exactly its columns, after dedup_lines(); rows of whose text nothing is left go, and length_col, if there, follows the text."""
    cut = cut_lines(docs, id_col, text_col, min_lines, passage, runs_wanted=False).filter("n_deleted < n_lines OR n_deleted = 0")

    def column(c: str) -> Column:
        old = F.col("row").getField(c)
        if c == text_col:
            return F.col("text").alias(c)
        if c == length_col:
            return F.when(F.col("n_deleted") > 0, F.length("text")).otherwise(old).cast(docs.schema[c].dataType).alias(c)
        return old.alias(c)

    return cut.select(*map(column, docs.columns))
