r"""Secret scans by a trigram inverted index (op 9, native).

From every rule's regular expression a Boolean trigram query is derived: the literal strings that each match must
hold, as an AND of ORs of trigram ANDs. One scan of the texts writes posting lists for the trigrams that
the queries name (of lower-cased text), split by a shard of the document id so that no list is
large; the queries then intersect and unite posting arrays shard by shard, and the candidates alone are
verified with the expressions. A rule without a mandatory trigram scans every text, in that same first scan.

Everything is DataFrame functions. Spans are code points, end exclusive: the pieces between
matches and the matches themselves give the offsets.

Kinds: assign, access, hex as stated by their patterns and least sizes, and private_key, web_token and
platform_token, which add spans. Null and empty texts have none. Rows that repeat a doc_id are matched by id and text,
so repeated rows get the same result; spans with one start come in the order of the kinds; an empty table gives an empty
result; only doc_id and text are read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spotweave.llm.columns import indices, let, running_sums, sha256_hex
from spotweave.runtime import broadcast_if_small, stage


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    least: int = 0  # characters of group `group` that a match needs
    group: int = 0


# The base kinds.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 18),
    Rule("hex", r"[0-9a-f]+", 16),
)
ADDED = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("platform_token", r"(?:ghp_|glpat-|xoxb-)[A-Za-z0-9-]{20,}"),
)
RULES = (*BASE, *ADDED)
MOST_STRINGS = 64


def required_strings(pattern: str) -> list[set[str]]:
    """Sets of lower-case strings; every match holds, of each set, at least one string.

    Consecutive pieces with few alternatives are multiplied out; a repeat or a wide class ends a piece."""
    from re import _parser as parser

    out: list[set[str]] = []

    def flush(now: set[str]) -> set[str]:
        if all(now):
            out.append(now)
        return {""}

    def strings(node) -> set[str] | None:
        """All strings of a node, or None if there are too many."""
        op, arg = str(node[0]), node[1]
        if op == "LITERAL":
            return {chr(arg).lower()}
        if op == "IN":
            if all(str(o) == "LITERAL" for o, _ in arg) and len(arg) <= 4:
                return {chr(a).lower() for _, a in arg}
            return None
        if op == "SUBPATTERN":
            return sequence(arg[-1])
        if op == "BRANCH":
            parts = [sequence(b) for b in arg[1]]
            return None if any(p is None for p in parts) else set().union(*parts)
        if op in ("MAX_REPEAT", "MIN_REPEAT") and arg[1] == 1 and arg[0] == 0:
            inner = sequence(arg[2])
            return None if inner is None else inner | {""}
        return None

    def sequence(nodes) -> set[str] | None:
        now = {""}
        for node in nodes:
            got = strings(node)
            if got is None or len(got) * len(now) > MOST_STRINGS:
                return None
            now = {a + b for a, b in product(now, got)}
        return now

    def walk(nodes, now: set[str]) -> set[str]:
        for node in nodes:
            got = strings(node)
            if got is not None and len(got) * len(now) <= MOST_STRINGS:
                now = {a + b for a, b in product(now, got)}
                continue
            now = flush(now)
            op, arg = str(node[0]), node[1]
            if op == "SUBPATTERN":
                now = flush(walk(arg[-1], now))
            elif op in ("MAX_REPEAT", "MIN_REPEAT") and arg[0] >= 1:
                now = flush(walk(arg[2], now))
        return now

    flush(walk(parser.parse(pattern), {""}))
    return out


def trigrams(s: str) -> frozenset[str]:
    return frozenset(s[i : i + 3] for i in range(len(s) - 2))


def trigram_query(pattern: str) -> list[list[frozenset[str]]]:
    """AND over a list of ORs over sets of trigrams that must all occur; empty: nothing is mandatory."""
    query = []
    for options in required_strings(pattern):
        sets = {trigrams(s) for s in options}
        if frozenset() not in sets:
            least = [s for s in sets if not any(t < s for t in sets)]  # a set that holds another one adds nothing
            query.append(sorted(least, key=sorted))
    return query


def find_spans(text: Column, rule: Rule, order: int) -> Column:
    """array<struct<start, kind, end>> of a rule's matches that are long enough."""
    least = rule.least
    if rule.pattern in ("[0-9a-f]+",):  # one run of one class: the size can be asked for at once, with the same matches
        pattern, rows = f"[0-9a-f]{{{least},}}", None
    else:
        pattern, rows = rule.pattern, (rule.group if least else None)

    def placed(found: Column) -> Column:
        between = F.split(text, pattern, -1)

        def offsets(pieces: Column) -> Column:
            gaps = F.transform(indices(F.size(found)), lambda i: F.length(F.get(pieces, i)) + F.when(i > 0, F.length(F.get(found, F.greatest(i - 1, F.lit(0))))).otherwise(0))
            spans = lambda s: F.transform(indices(F.size(found)), lambda i: F.struct(F.get(s, i).alias("start"), F.lit(order).alias("kind"), (F.get(s, i) + F.length(F.get(found, i))).alias("end")))
            return let(running_sums(gaps), spans)

        all_spans = let(between, offsets)
        if rows is None:
            return all_spans
        sizes = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(rows)), F.length)
        return let(sizes, lambda z: F.filter(all_spans, lambda _, i: F.get(z, i) >= least))

    nothing = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return F.when(text.rlike(pattern), let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)).otherwise(nothing)


def posting_lists(keyed: DataFrame, grams: list[str], shards: int) -> DataFrame:
    """(shard, gram, ids): sorted ids of the texts whose lower-cased form holds the trigram."""
    has = F.filter(F.array(*[F.lit(g) for g in grams]), lambda g: F.contains(F.col("lowered"), g))
    rows = keyed.withColumn("lowered", F.lower("text")).select(F.pmod("key", F.lit(shards)).alias("shard"), F.explode(has).alias("gram"), "key")
    return rows.groupBy("shard", "gram").agg(F.array_sort(F.collect_set("key")).alias("ids"))


def candidates(lists: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """key of the texts that satisfy some rule's trigram query, by intersecting and uniting posting arrays."""
    by_gram = lists.groupBy("shard").agg(F.map_from_entries(F.collect_list(F.struct("gram", "ids"))).alias("p"))
    none = F.array().cast("array<bigint>")
    ids = lambda g: F.coalesce(F.element_at("p", F.lit(g)), none)
    every = lambda grams: reduce(F.array_intersect, [ids(g) for g in sorted(grams)])
    of_rule = lambda r: reduce(F.array_intersect, [reduce(F.array_union, [every(o) for o in options]) for options in trigram_query(r.pattern)])
    found = reduce(F.array_union, [of_rule(r) for r in rules])
    return by_gram.select(F.explode(found).alias("key")).distinct()


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, *, shard_docs: int = 4096, max_broadcast: int = 1_000_000) -> DataFrame:
    """doc_id, n_<kind> of the base kinds, base_sha256 and spans for every row of docs."""
    indexed = tuple(r for r in rules if trigram_query(r.pattern))
    full = tuple(r for r in rules if r not in indexed)
    grams = sorted({g for r in indexed for options in trigram_query(r.pattern) for o in options for g in o})
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("doc_id", "text").alias("key"))
    shards = max(1, -(-docs.count() // shard_docs))
    order = {r.kind: i for i, r in enumerate(rules)}
    if indexed:
        hits = stage(candidates(stage(posting_lists(keyed, grams, shards), "secrets-index"), indexed), "secrets-candidates")
        hits = broadcast_if_small(hits.withColumn("candidate", F.lit(True)), max_broadcast)
        keyed = keyed.join(hits, "key", "left")
    else:
        keyed = keyed.withColumn("candidate", F.lit(False))
    nothing = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    text = F.col("text")
    verified = F.concat(*[find_spans(text, r, order[r.kind]) for r in indexed], nothing)
    scanned = F.concat(*[find_spans(text, r, order[r.kind]) for r in full], nothing)
    spans = F.array_sort(F.concat(F.when(F.col("candidate"), verified).otherwise(nothing), scanned))
    found = keyed.select("doc_id", spans.alias("s"))
    names = F.array(*[F.lit(r.kind) for r in rules])
    say = lambda s: F.array_join(F.transform(s, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["end"])), ",")
    base = F.filter("s", lambda x: x["kind"] < len(BASE))
    of_kind = lambda i: F.filter("s", lambda x: x["kind"] == i)
    counts = [F.size(of_kind(i)).cast("long").alias(f"n_{r.kind}") for i, r in enumerate(BASE)]
    return found.select("doc_id", *counts, sha256_hex(say(base)).alias("base_sha256"), say(F.col("s")).alias("spans"))
