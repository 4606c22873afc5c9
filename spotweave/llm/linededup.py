r"""Line dedup by winnowing over line hashes (op 6, native).

A line is a stretch of text up to a newline or, as web text often holds whole pages in one physical
line, up to the end of a sentence; its separators stay with it, so that the lines of a text joined are the
text. Blank lines are left out of what follows, but go with a run that they lie in. Per document:

1. windows: from every line on, the shortest run that has `least_chars` characters;
2. fingerprints: the minimum of every window in the order of lines by length, the longest first, then by hash, the first
   of equals. A repeated run of `least_chars` characters holds a window, so its fingerprint stands in both places, as far from
   the start: none is missed, and lines that stand everywhere are seldom chosen;
3. positions: fingerprints are counted, and those that stand in several places are joined back to their positions;
4. extension: around each such position, forwards and backwards, to all shortest runs of `least_chars` characters from
   and up to each line that hold it. Stretches without a shared fingerprint are never hashed. The keys of the runs are
   aggregated to their first place (document, then position);
5. deletion: a run whose key has an earlier place is deleted. The first occurrence stays.

A stretch of lines of at least `least_chars` characters that an earlier place holds is covered by such runs: its
first lines by the run forward from its start, all others by the runs backward from them. So it goes whole,
and neighbours that are repeated from different places are deleted only if each has a run of its own.
Repeated runs of fewer characters stay.

Only DataFrame functions are used. Hot lines are aggregated before the shuffle; the joins back are plain
equi-joins that adaptive execution splits; nothing is gathered by line, only by document. Texts are read once to find
fingerprints, whose table holds 12 bytes and a few bits of each line; runs come from that table.

Null texts stay null and empty texts empty; rows with a null doc_id are left as they are; rows that
share a doc_id are one place, so they never delete each other's text, and repeated rows get the same
result; ties of a hash go to the first position; empty tables give empty results; dedup_lines() returns
its own columns and deduplicated() keeps all columns of its input, whatever their names. Lines are compared by two hashes of
64 and 32 bits, runs by two of 64 bits, as one of 64 bits would meet by chance in some of 10 ** 12 lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spotweave.llm.columns import indices, let
from spotweave.runtime import broadcast_if_small, stage, unstage

#: Lines end after these: a newline, or the space that follows the end of a sentence.
ENDS = ("\n", ". ", "! ", "? ")
MARK = "\x01"
LEVELS = 5  # sums of 2, 4, 8, 16 and 32 lines find a window of up to 32 lines by halving; longer ones are added up


def lines_of(text: Column) -> Column:
    """The lines of a text with their separators; joined they are the text."""
    text = F.coalesce(text, F.lit(""))
    marked = text
    for end in ENDS:
        marked = F.replace(marked, F.lit(end), F.lit(end + MARK))
    slow = "|".join(f"(?<={'[.]' if e[0] == '.' else '[?]' if e[0] == '?' else e[0]}{e[1:]})" for e in ENDS)
    found = F.when(F.contains(text, F.lit(MARK)), F.split(text, slow, -1)).otherwise(F.split(marked, MARK, -1))
    return F.filter(found, lambda x: x != "")


def window_lines(sums: list[Column], i: Column, least_chars: int) -> Column:
    """Lines of the shortest run of least_chars characters from line i on, null where the text ends before; sums[k] are the sums of
    the 2 ** k lengths from each line on, as far as there are lines."""

    def halved(k: int, before: Column | None, n: int) -> Column:
        """The answer, known to lie within 2 ** k lines after the first n, which have `before` characters."""
        if k == 0:
            return F.lit(n + 1)
        half = 1 << (k - 1)
        there = F.coalesce(F.get(sums[k - 1], i + n), F.lit(0))
        total = there if before is None else before + there
        return F.when(total >= least_chars, halved(k - 1, before, n)).otherwise(halved(k - 1, total, n + half))

    # a line has a character at least, so no run is longer than least_chars lines
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("s"))
    add = lambda a, x: F.struct((a["n"] + F.when(a["s"] < least_chars, 1).otherwise(0)).alias("n"), (a["s"] + x).alias("s"))
    longer = F.aggregate(F.slice(sums[0], i + 1, least_chars), zero, add, lambda a: F.when(a["s"] >= least_chars, a["n"]))
    most = len(sums) - 1
    return F.when(F.get(sums[most], i) >= least_chars, halved(most, None, 0)).when(i + (1 << most) < F.size(sums[0]), longer)


def line_table(docs: DataFrame, least_chars: int) -> DataFrame:
    """For each document, of its lines that are not blank: h and g (two hashes), blanks (blank lines before it), n (lines of the window
    from it on, null where the text ends before), and prints (numbers of the lines that are the minimum of a window)."""
    trimmed = F.transform(lines_of(F.col("text")), lambda x: F.btrim(x, F.lit(" \n\r\t")))
    lines = F.filter(F.transform(trimmed, lambda x, i: F.struct(F.xxhash64(x).alias("h"), F.hash(x).alias("g"), F.length(x).alias("l"), i.alias("at"))), lambda x: x["l"] > 0)

    def with_sums(lengths: Column, body) -> Column:
        """body(sums), each list of sums computed once."""

        def more(sums: list[Column]) -> Column:
            if len(sums) > LEVELS:
                return body(sums)
            far = 1 << (len(sums) - 1)
            return let(F.transform(sums[-1], lambda v, i: v + F.coalesce(F.get(sums[-1], i + far), F.lit(0))), lambda twice: more([*sums, twice]))

        return let(lengths, lambda one: more([one]))

    def found(x: Column, n: Column) -> Column:
        order = F.transform(x, lambda v: F.shiftleft(v["l"].cast("long"), 40) + v["h"].bitwiseAND(F.lit((1 << 40) - 1)))
        least = lambda window, i: i + F.array_position(window, F.array_max(window)).cast("int") - 1
        known = lambda o: F.transform(n, lambda m, i: F.when(m.isNotNull(), let(F.slice(o, i + 1, m), lambda window: least(window, i))))
        prints = let(order, lambda o: F.array_distinct(F.array_compact(known(o))))
        return F.struct(x["h"].alias("h"), x["g"].alias("g"), F.transform(x["at"], lambda at, i: at - i).alias("blanks"), n.alias("n"), prints.alias("prints"))

    def table(x: Column) -> Column:
        windows = lambda sums: F.transform(indices(F.size(sums[0])), lambda i: window_lines(sums, i, least_chars))
        return with_sums(x["l"], lambda sums: let(windows(sums), lambda n: found(x, n)))

    return docs.where("doc_id is not null").select("doc_id", let(lines, table).alias("t")).select("doc_id", "t.*")


def shared_places(table: DataFrame) -> DataFrame:
    """(doc_id, anchors): the numbers of the lines whose fingerprints stand in several places, sorted."""
    prints = table.select("doc_id", F.explode(F.transform("prints", lambda p: F.struct(p.alias("p"), F.get("h", p).alias("f")))).alias("v")).select("doc_id", "v.*")
    shared = stage(prints.groupBy("f").agg(F.count("*").alias("n")).where("n > 1").select("f"), "line-prints")  # a table of its own, so that the join back can split a hot line
    return prints.join(shared, "f", "left_semi").groupBy("doc_id").agg(F.array_sort(F.collect_set("p")).alias("anchors"))


def runs_around(table: DataFrame, places: DataFrame) -> DataFrame:
    """(doc_id, f, g, at, to): two hashes, first and last position of all shortest runs from and up to a line that hold an anchor."""
    at = lambda i: i + F.get("blanks", i)
    run = lambda i, j: F.struct(
        F.xxhash64(F.slice("h", i + 1, j - i + 1)).alias("f"), F.xxhash64(F.lit("g"), F.slice("g", i + 1, j - i + 1)).alias("g"), at(i).alias("at"), at(j).alias("to")
    )

    def stretch(i: Column, first: Column) -> Column:
        """Runs from line i that end at line `first` or later: a line between the ends of the windows of two lines in a row ends one."""
        last = F.greatest(i + F.get("n", i), F.coalesce(i + 1 + F.get("n", i + 1), F.size("h") + 1) - 1) - 1
        return F.when(first <= last, F.transform(F.sequence(first, last), lambda j: run(i, j)))

    # the next anchor of every line up to the last anchor
    following = F.flatten(F.transform("anchors", lambda a, k: F.array_repeat(a, a - F.when(k > 0, F.get("anchors", k - 1)).otherwise(-1))))
    none = F.array().cast("array<struct<f:bigint,g:bigint,at:int,to:int>>")
    runs = lambda next_: F.flatten(F.transform("n", lambda m, i: F.coalesce(F.when(m.isNotNull() & F.get(next_, i).isNotNull(), stretch(i, F.greatest(i + m - 1, F.get(next_, i)))), none)))
    return table.join(places, "doc_id").select("doc_id", F.explode(let(following, runs)).alias("r")).select("doc_id", "r.*")


def repeated_lines(docs: DataFrame, *, least_chars: int = 100) -> DataFrame:
    """(doc_id, gone): positions of the lines to delete, sorted; documents without any are left out."""
    table = stage(line_table(docs, least_chars), "line-hashes")
    runs = stage(runs_around(table, shared_places(table)), "line-runs")
    unstage(table)
    first = runs.groupBy("f", "g").agg(F.min(F.struct("doc_id", "at")).alias("first"), F.count("*").alias("n")).where("n > 1").select("f", "g", F.col("first.doc_id").alias("doc0"), F.col("first.at").alias("at0"))
    first = stage(first, "line-first")
    later = runs.join(first, ["f", "g"]).where("doc_id <> doc0 or at <> at0")
    spans = F.array_distinct(F.flatten(F.transform(F.collect_list(F.struct("at", "to")), lambda x: F.sequence(x["at"], x["to"]))))
    return later.groupBy("doc_id").agg(F.array_sort(spans).alias("gone"))


def without_lines(text: Column, gone: Column) -> Column:
    """The text without the lines at the sorted positions gone."""
    def kept(x: Column) -> Column:
        stay = F.array_except(indices(F.size(x)), gone)  # a hash set: linear, and in order
        return F.array_join(F.transform(stay, lambda i: F.get(x, i)), "")

    return let(lines_of(text), kept)


def unused(docs: DataFrame, name: str) -> str:
    """A column name that docs does not have."""
    while name.lower() in [c.lower() for c in docs.columns]:
        name += "_"
    return name


def _edited(docs: DataFrame, max_broadcast: int, **how) -> tuple[DataFrame, DataFrame, str]:
    """Rows that stay as they are, rows to edit, and the name of their column of positions to delete."""
    key, edit = unused(docs, "edit_id"), unused(docs, "edit")
    gone = stage(repeated_lines(docs, **how), "lines-gone").select(F.col("doc_id").alias(key), F.col("gone").alias(edit))
    ids = broadcast_if_small(gone.select(key), max_broadcast)
    rest = docs.join(ids, docs["doc_id"] == ids[key], "left_anti")
    changed = docs.join(ids, docs["doc_id"] == ids[key], "left_semi")
    return rest, changed.join(gone, changed["doc_id"] == gone[key]).drop(key), edit


def dedup_lines(docs: DataFrame, *, max_broadcast: int = 1_000_000, **how) -> DataFrame:
    """doc_id, n_lines, n_removed, removed_chars and text (what is left) for every row of docs."""
    rest, changed, edit = _edited(docs.select("doc_id", "text"), max_broadcast, **how)
    size = lambda: F.size(lines_of(F.col("text"))).cast("long").alias("n_lines")
    kept = rest.select("doc_id", size(), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("removed_chars"), "text")
    left = changed.select("doc_id", size(), F.size(edit).cast("long").alias("n_removed"), F.length("text").alias("was"), without_lines(F.col("text"), F.col(edit)).alias("text"))
    return kept.unionByName(left.select("doc_id", "n_lines", "n_removed", (F.col("was") - F.length("text")).cast("long").alias("removed_chars"), "text"))


def deduplicated(docs: DataFrame, *, max_broadcast: int = 1_000_000, **how) -> DataFrame:
    """docs with repeated runs deleted from text and n_chars, where there is one, brought up to date;
    documents that consist of repeats altogether are dropped."""
    rest, changed, edit = _edited(docs, max_broadcast, **how)
    left = changed.withColumn("text", without_lines(F.col("text"), F.col(edit))).drop(edit).where(F.length(F.btrim("text", F.lit(" \n\r\t"))) > 0)
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return rest.unionByName(left.select(*rest.columns))
