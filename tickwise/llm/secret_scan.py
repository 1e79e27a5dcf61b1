"""Secret scans: pattern hits, and weak parts that only count together.

Base kinds (assign, access, hex) are reported wherever they match.  The weak
parts - account names, long mixed-case random strings, endpoints - mean nothing
alone.  They are linked by an interval join within scopes: parts lie on the
text as intervals, and a part is joined with the nearest part of each other
role before and after it that doesn't overlap it, found by running maxima of
ends and minima of starts over the document's sorted edges, so that no pair is
spelled out.  A weak part is reported when a complementary role is within
``SCOPE`` code points: a random string with an identifier or an endpoint, an
account name or an endpoint with a secret.

A random string in the path of a URL is mostly a title, and part of that URL: it
counts only if a part of it between ``-``, ``/`` and ``_`` is random by itself,
and then with identifiers only, never with an endpoint.  Values behind ``=``, queries and user info of a
URL are secrets like any other.

Only DataFrame functions run.  Places come from splitting a text at its
matches: lengths of the pieces and of the matches, added up by a window over
the document's hits; the text itself is not shuffled.

A null text counts as empty; every input row gives one row, repeated rows too;
a row without spans has counts 0, an empty ``spans`` and the digest of ``""``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SCOPE = 200

#: kind -> (pattern, capture group to measure, its least length, role), in order of report.
KINDS = {
    "assign": (r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""",
               2, 6, "secret"),
    "access": (r"AKIA[A-Z0-9]{16,}", 0, 20, "identifier"),
    "hex": (r"[0-9a-f]{24,}", 0, 24, "secret"),
    # weak kinds
    "account": (r"""(?i:(?:user(?:name)?|login|account|client_?id|access_?key_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.@=-]+))""",
                1, 3, "identifier"),
    # maximal runs, judged whole; "=" ends a run, as padding or as the sign after a key's name
    "random": (r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z0-9+/_-]{20}|[A-Za-z0-9+/_-]{18}(?:==|[A-Za-z0-9+/_-]=)"
               r"(?![A-Za-z0-9+/_=-]))(?=[A-Za-z+/_-]*+[0-9])(?=[a-z0-9+/_-]*+[A-Z])(?=[A-Z0-9+/_-]*+[a-z])"
               r"[A-Za-z0-9+/_-]++(?:={1,2}(?![A-Za-z0-9+/_=-]))?", 0, 20, "secret"),
    "endpoint": (r"""(?i:https?|ftp|ssh|jdbc:[a-z]+|postgres|mysql|mongodb|redis|amqp)://[^\x20\x09-\x0D"'<>]+""",
                 0, 10, "endpoint"),
}
BASE = ("assign", "access", "hex")
#: role of a weak part -> roles that complete it
COMPLETES = {"secret": ("identifier", "endpoint"), "identifier": ("secret",), "endpoint": ("secret",)}
#: the same with random strings in the path of a URL
LINKS = {**COMPLETES, "identifier": ("secret", "path"), "path": ("identifier",)}
#: a URL up to its path: scheme, user info (a password may hold "/", a port is none), host
AUTHORITY = r"^[^/]*//(?:[^/?#@:]*:(?![0-9]{1,5}/)[^?#@]*@|[^/?#@]*@)?[^/?#]*"


def _hits(text: Column, order: int, kind: str) -> Column:
    """Array of (order, k, gap, len, good, path, query, mark): the piece before match k and
    the match.  Of an endpoint, where its path, query and fragment begin; of a random
    string, path is 0 if it counts wherever it is, 1 if within a path, too, and 2 if not there."""
    pattern, group, least, _ = KINDS[kind]
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    measured = whole if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    pieces = F.split(text, pattern)
    hits = F.transform(whole, lambda m, k: F.struct(
        F.lit(order).alias("kind"), k.alias("k"), F.length(F.get(pieces, k)).alias("gap"),
        F.length(m).alias("len"), (F.length(F.get(measured, k)) >= least).alias("good"),
        *(c.alias(n) for n, c in zip(("path", "query", "mark"), _marks(kind, m, F.get(pieces, k)), strict=True))))
    empty = F.array().cast("array<struct<kind:int,k:int,gap:int,len:int,good:boolean,path:int,query:int,mark:int>>")
    # one cheap look first: most texts have no hit of a kind
    return F.when(text.rlike(pattern), hits).otherwise(empty)


def _marks(kind: str, match: Column, piece: Column) -> tuple[Column, Column, Column]:
    none = F.lit(None).cast("int")
    if kind == "endpoint":
        return tuple(F.length(F.regexp_extract(match, p, 0)) for p in (AUTHORITY, "^[^?#]*", "^[^#]*"))
    if kind == "random":
        segment = F.exists(F.split(match, "[-/_]"), lambda x: x.rlike(KINDS["random"][0]))
        return F.when(piece.endswith("="), 0).when(segment, 1).otherwise(2), none, none
    return none, none, none


def find_spans(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
               scope: int = SCOPE) -> DataFrame:
    """One row per input row: ``keep`` (a struct) and ``spans``, an array of
    (start, kind, end) sorted; kind counts in the order of ``KINDS``."""
    kinds = list(KINDS)
    text = F.coalesce(F.col(text_col), F.lit(""))
    hits = docs.select(
        F.struct(*keep).alias("keep"), F.monotonically_increasing_id().alias("row"),
        F.concat(*(_hits(text, i, k) for i, k in enumerate(kinds))).alias("hits"))
    rows = hits.select("row", "keep", F.explode_outer("hits").alias("h")).select("row", "keep", "h.*")
    by_kind = Window.partitionBy("row", "kind").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.withColumn("end", F.sum(F.col("gap") + F.col("len")).over(by_kind).cast("long")) \
        .withColumn("start", F.col("end") - F.col("len"))
    # hits that are too short have moved the scan on, and count for nothing else
    role = F.element_at(F.array(*(F.lit(KINDS[k][3]) for k in kinds)), F.col("kind") + 1)
    # the last endpoint that begins before a random string, and whether the string lies in its path or fragment
    so_far = Window.partitionBy("row").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, 0)
    url = F.last(F.when((F.col("kind") == kinds.index("endpoint")) & F.col("good"), F.struct(
        (F.col("start") + F.col("path")).alias("path"), (F.col("start") + F.col("query")).alias("query"),
        (F.col("start") + F.col("mark")).alias("mark"), "end")), ignorenulls=True).over(so_far)
    within = (F.col("start") < F.col("url.query")) & (F.col("end") > F.col("url.path")) | \
        (F.col("start") < F.col("url.end")) & (F.col("end") > F.col("url.mark"))
    in_path = F.coalesce((F.col("kind") == kinds.index("random")) & (F.col("path") > 0) & within, F.lit(False))
    tagged = placed.withColumn("url", url).withColumn("role", F.when(F.col("good"), F.when(
        in_path, F.when(F.col("path") == 1, F.lit("path"))).otherwise(role)))
    # two edges a hit, ends before starts: what ends before a start, and starts after an end, doesn't overlap
    edges = tagged.select("row", "keep", "kind", "start", "end", "good", "role", F.explode_outer(F.when(
        F.col("kind").isNotNull(), F.array(F.struct(F.col("end").alias("at"), F.lit(0).alias("opens")),
                                           F.struct(F.col("start").alias("at"), F.lit(1).alias("opens"))))).alias("edge")) \
        .select("*", "edge.*").drop("edge")
    order = Window.partitionBy("row").orderBy("at", "opens")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(1, Window.unboundedFollowing)
    for r in LINKS:
        edges = edges.withColumn(f"before_{r}", F.max(F.when((F.col("role") == r) & (F.col("opens") == 0), F.col("at"))).over(before)) \
            .withColumn(f"after_{r}", F.min(F.when((F.col("role") == r) & (F.col("opens") == 1), F.col("at"))).over(after))

    def near(r: str) -> Column:
        gap = F.when(F.col("opens") == 1, F.col("at") - F.col(f"before_{r}")).otherwise(F.col(f"after_{r}") - F.col("at"))
        return F.coalesce(gap <= scope, F.lit(False))

    linked = F.lit(False)
    for r, others in LINKS.items():
        for o in others:
            linked = linked | ((F.col("role") == r) & near(o))
    strong = F.col("kind") < len(BASE)
    reported = edges.withColumn("span", F.when(
        F.col("good") & (strong | linked), F.struct("start", "kind", "end")))
    return reported.groupBy("row").agg(
        F.first("keep").alias("keep"), F.sort_array(F.collect_set("span")).alias("spans")).drop("row")


def _joined(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))))


def _of_kind(kind: int) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def secret_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """Counts of the base kinds, their digest, and all spans as text; weak parts complete
    each other within ``scope`` code points."""
    found = find_spans(docs, text_col, (id_col,), scope)
    base = F.filter("spans", lambda s: s["kind"] < len(BASE))
    counts = [_of_kind(i).alias(f"n_{k}") for i, k in enumerate(BASE)]
    return found.select(F.col("keep")[id_col].alias(id_col), *counts,
                        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, text_col: str = "text", key: tuple[str, ...] = ("doc_id",),
           mask: str = "[SECRET]") -> DataFrame:
    """The input rows with every reported span, overlaps merged, replaced by ``mask``.

    Only spans travel to the texts: they are found per (key, digest of the text)
    and joined back on it, so equal rows share them."""
    digest = F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)
    named = docs.select(*key, F.col(text_col), digest.alias("_digest"))
    spans = find_spans(named, text_col, ("_digest",)).where(F.size("spans") > 0) \
        .select(F.col("keep")["_digest"].alias("_digest"), F.col("spans").alias("_spans")) \
        .groupBy("_digest").agg(F.first("_spans").alias("_spans"))
    joined = docs.select(F.struct(*docs.columns).alias("row"), digest.alias("_digest")) \
        .join(spans, "_digest", "left")
    text = F.col("row")[text_col]
    # pieces between spans: each span starts at the furthest end so far, if that is later
    reach = F.aggregate(
        "_spans", F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out")),
        lambda a, s: F.struct(
            F.greatest(a["at"], s["end"]).alias("at"),
            F.when(s["start"] >= a["at"], F.concat(
                a["out"], F.substring(text, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")), F.lit(mask)))
            .otherwise(a["out"]).alias("out")),
        lambda a: F.concat(a["out"], F.substring(text, (a["at"] + 1).cast("int"), F.length(text))))
    clean = F.when(F.col("_spans").isNull(), text).otherwise(reach)
    return joined.select(*(clean.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns))


def _either_case(words: str) -> str:
    """ASCII letters of an alternation in either case (SQL's own folding knows more letters)."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


def report_sql() -> str:
    """The same report in DuckDB SQL, whose patterns have no look-around: random strings
    are taken from runs with all "=" behind them, and what follows a run is told by the gap
    before the next one."""
    value = r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    account = _either_case("(?:user(?:name)?|login|account|client_?id|access_?key_?id)")
    patterns = {
        "assign": ("(" + _either_case("password|passwd|secret|token|api_?key") + ")" + value, 2, "length(g) >= 6"),
        "access": (KINDS["access"][0], 0, "true"),
        "hex": (KINDS["hex"][0], 0, "true"),
        "account": (account + value.replace("_.=", "_.@="), 1, "length(g) >= 3"),
        "endpoint": ("(?:" + "|".join(map(_either_case, ("https?", "ftp", "ssh"))) + "|" + _either_case("jdbc") + ":"
                     + "[a-zA-Z]+|" + "|".join(map(_either_case, ("postgres", "mysql", "mongodb", "redis", "amqp")))
                     + r""")://[^\x20\x09-\x0D"'<>]+""", 0, "length(m) >= 10"),
    }

    def matches(pattern: str, group: int = 0) -> str:
        p = "'" + pattern.replace("'", "''") + "'"
        return f"""(SELECT * FROM (SELECT rid, unnest(regexp_extract_all(t, {p}, 0)) AS m, unnest(regexp_extract_all(t, {p}, {group})) AS g,
         unnest(string_split_regex(t, {p})) AS piece, generate_subscripts(string_split_regex(t, {p}), 1) AS k FROM d)
   WHERE m IS NOT NULL)"""

    placed = "CAST(sum(length(piece) + length(m)) OVER (PARTITION BY rid ORDER BY k) AS BIGINT) AS e, length(m) AS len"
    hits = [f"""SELECT rid, {list(KINDS).index(kind)} AS kind, {good} AS good, e - len AS s, e, NULL AS path,
       CASE WHEN {kind == "endpoint"} THEN m END AS url FROM (SELECT *, {placed} FROM {matches(pattern, group)})"""
            for kind, (pattern, group, good) in patterns.items()]

    def random(x: str) -> str:
        return f"regexp_matches({x}, '^([^=]{{20,}}=*|[^=]{{18}}==|[^=]{{19}}=)$') AND " + " AND ".join(
            f"regexp_matches({x}, '{c}')" for c in ("[0-9]", "[A-Z]", "[a-z]"))

    hits.append(f"""SELECT rid, {list(KINDS).index("random")}, true, s, s + length(x), CASE WHEN named THEN 0
       WHEN len(list_filter(string_split_regex(x, '[-/_]'), lambda y: {random("y")})) > 0 THEN 1 ELSE 2 END, NULL
  FROM (SELECT rid, s, named, run || CASE WHEN pad <= 2 AND next > 0 THEN repeat('=', pad) ELSE '' END AS x
        FROM (SELECT rid, rtrim(m, '=') AS run, len - length(rtrim(m, '=')) AS pad, e - len AS s,
                     right(piece, 1) = '=' OR (piece = '' AND coalesce(right(lag(m) OVER r, 1) = '=', false)) AS named,
                     coalesce(lead(length(piece)) OVER r, 1) AS next
              FROM (SELECT *, {placed} FROM {matches("[A-Za-z0-9+/_-]+=*")}) WINDOW r AS (PARTITION BY rid ORDER BY k)))
  WHERE {random("x")}""")
    port = "'^[^/]*//[^/?#@:]*:[0-9]{1,5}/'"
    host = "'^[^/]*//(?:[^/?#@]*@)?[^/?#]*'"
    full = "'^[^/]*//(?:[^/?#@:]*:[^?#@]*@|[^/?#@]*@)?[^/?#]*'"
    roles = " ".join(f"WHEN {i} THEN '{r}'" for i, (_, _, _, r) in enumerate(KINDS.values()))
    names = " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(KINDS))
    near = ",\n".join(
        f"max(edge) FILTER (WHERE role = '{r}' AND opens = 0) OVER (b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before_{r},\n"
        f"min(edge) FILTER (WHERE role = '{r}' AND opens = 1) OVER (b ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS after_{r}"
        for r in LINKS)
    linked = " OR ".join(
        f"(role = '{r}' AND coalesce(CASE opens WHEN 1 THEN edge - before_{o} ELSE after_{o} - edge END <= {SCOPE}, false))"
        for r, others in LINKS.items() for o in others)
    counts = ", ".join(f"count(*) FILTER (WHERE kind = {i}) AS n_{k}" for i, k in enumerate(BASE))
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
h AS ({" UNION ALL ".join(hits)}),
u AS (SELECT *, last_value(CASE WHEN url IS NOT NULL AND good THEN struct_pack(
               p := s + length(regexp_extract(url, CASE WHEN regexp_matches(url, {port}) THEN {host} ELSE {full} END)),
               q := s + length(regexp_extract(url, '^[^?#]*')), f := s + length(regexp_extract(url, '^[^#]*')), e := e) END IGNORE NULLS)
             OVER (PARTITION BY rid ORDER BY s, kind ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS l FROM h),
r AS (SELECT rid, kind, good, s, e, CASE WHEN NOT good THEN NULL
               WHEN coalesce(path > 0 AND ((s < l.q AND e > l.p) OR (s < l.e AND e > l.f)), false)
               THEN CASE path WHEN 1 THEN 'path' END ELSE CASE kind {roles} END END AS role FROM u),
g AS (SELECT *, e AS edge, 0 AS opens FROM r UNION ALL SELECT *, s, 1 FROM r),
n AS (SELECT *, {near} FROM g WINDOW b AS (PARTITION BY rid ORDER BY edge, opens)),
f AS (SELECT DISTINCT rid, kind, s, (CASE kind {names} END) || ':' || s || ':' || e AS span FROM n
      WHERE good AND (kind < {len(BASE)} OR {linked})),
a AS (SELECT rid, {counts}, string_agg(span, ',' ORDER BY s, kind) FILTER (WHERE kind < {len(BASE)}) AS base,
             string_agg(span, ',' ORDER BY s, kind) AS spans FROM f GROUP BY rid)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in BASE)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a USING (rid)"""
