"""Secret scans with linking of credentials that come in several parts.

Strong patterns are reported wherever they stand. Weak parts (short or opaque
values, other access identifiers, logins, endpoints) are reported only when the
parts that complete them stand within `reach` code points in the same document,
found by an interval join on bins of that width.

All patterns are runs of one character class, or begin with fixed words, and
none repeats a group, so that a match takes time in proportion to its length
and no stack, whatever the text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftscan.session import materialize


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_KEYS = "|".join(_any_case(x) for x in ("password", "passwd", "secret", "token")) + f"|{_any_case('api')}_?{_any_case('key')}"
_NAMES = "|".join(_any_case(x) for x in ("username", "login", "client_id"))
_SET = r"""["']?\x20*[:=]\x20*["']?"""
#: Patterns that are searched for, each on its own, leftmost and non-overlapping.
ASSIGN = rf"(?:{_KEYS}){_SET}([A-Za-z0-9+/_.=-]+)"
LOGIN = rf"(?:{_NAMES}){_SET}([A-Za-z0-9._@-]+)"
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]{16,}"
TOKEN = "[A-Za-z0-9+/_.@:-]{12,}"
#: Tokens that count, as wholes; an opaque one has capitals, small letters and digits besides.
SESSION_ID = "(?:ASIA|AIDA|AROA|AGPA|ANPA)[A-Z0-9]{12,}"
MAIL = r"[A-Za-z0-9._+-]+@[A-Za-z0-9.-]+\.[A-Za-z]+"
ENDPOINT = r"https?://.+|.+\.(?:amazonaws\.com|internal|local)(?::[0-9]+)?"
OPAQUE = "[A-Za-z0-9+/_-]{20,}"
#: Strong kinds, then weak ones, in the order in which they are listed, and the role that each plays.
ROLES = {
    "assign": "secret", "access": "id", "hex": "secret",
    "short_value": "secret", "login": "id", "short_access": "id", "short_hex": "secret", "session_id": "id", "mail": "id", "endpoint": "endpoint", "opaque": "secret",
}
KINDS = list(ROLES)
BASE = KINDS[:3]
SPAN = "array<struct<start:bigint,kind:int,stop:bigint>>"


def _let(value: Column, f) -> Column:
    """f(value), with value computed once however often f uses it: bound by a lambda, wherever the planner moves the expression."""
    return F.transform(F.array(value), f)[0]


def running(a: Column, op, first: int = 0) -> Column:
    """What op, an associative one, makes of an array of longs up to each of them, block by block, so that long arrays are not copied once an element."""
    zero, none = F.lit(first).cast("bigint"), F.array().cast("array<bigint>")

    def scan(xs: Column, start: Column) -> Column:
        first = F.struct(start.alias("s"), none.alias("xs"))
        return F.aggregate(xs, first, lambda acc, x: F.struct(op(acc["s"], x).alias("s"), F.concat(acc["xs"], F.array(op(acc["s"], x))).alias("xs")), lambda acc: acc["xs"])

    def joined(blocks: Column) -> Column:
        sums = scan(F.transform(blocks, lambda b: F.aggregate(b, zero, op)), zero)
        starts = F.concat(F.array(zero), sums)
        return F.flatten(F.zip_with(blocks, F.slice(starts, F.lit(1), F.size(blocks)), scan))

    def cut(xs: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.ceil(F.size(xs) / 128).cast("int") - 1), lambda b: F.slice(xs, b * 128 + 1, F.lit(128)))
        return F.when(F.size(xs) > 0, _let(blocks, joined)).otherwise(none)

    return _let(a, cut)


def prefix_sums(a: Column) -> Column:
    """Inclusive running sums of an array of longs."""
    return running(a, lambda s, x: s + x)


def matches(text: Column, pattern: str, sign: Column) -> Column:
    """start, stop (code points, the stop exclusive) and match of all matches; `sign` is what no text with a match can do without."""

    def length(x: Column) -> Column:
        return F.length(x).cast("bigint")

    def placed(x: Column) -> Column:
        ends = prefix_sums(F.zip_with(F.slice(x["between"], F.lit(1), F.size(x["found"])), x["found"], lambda p, m: length(p) + length(m)))
        return F.zip_with(ends, x["found"], lambda e, m: F.struct((e - F.length(m)).alias("start"), e.alias("stop"), m.alias("match")))

    both = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"), F.split(text, pattern, -1).alias("between"))
    none = F.array().cast("array<struct<start:bigint,stop:bigint,match:string>>")
    return F.when(sign & text.rlike(pattern), _let(both, placed)).otherwise(none)


def _kind(name: str) -> Column:
    return F.lit(KINDS.index(name))


def _spans(found: Column, kind) -> Column:
    """The matches to which kind (a function of the match) gives one."""
    told = F.transform(found, lambda m: F.struct(m["start"], kind(m["match"]).cast("int").alias("kind"), m["stop"]))
    return F.filter(told, lambda s: s["kind"].isNotNull()).cast(SPAN)


def all_parts(text: Column) -> Column:
    """The spans of all kinds in a text, by start, then kind."""

    def value(m: Column, pattern: str) -> Column:
        return F.length(F.regexp_extract(m, pattern, 1))

    def token(m: Column) -> Column:
        mixed = m.rlike("[A-Z]") & m.rlike("[a-z]") & m.rlike("[0-9]") & m.rlike(rf"\A{OPAQUE}\z")
        kinds = [(SESSION_ID, "session_id"), (MAIL, "mail"), (ENDPOINT, "endpoint")]
        out = F.when(F.lit(False), 0)
        for pattern, name in kinds:
            out = out.when(m.rlike(rf"\A(?:{pattern})\z"), _kind(name))
        return out.when(mixed, _kind("opaque"))

    def has(*words: str) -> Column:
        return reduce(lambda a, b: a | b, (F.contains(text, F.lit(w)) for w in words))

    set_of = has(":", "=")
    whole = has("@", "://", ".amazonaws.com", ".internal", ".local", "ASIA", "AIDA", "AROA", "AGPA", "ANPA") | text.rlike(OPAQUE)
    return F.array_sort(
        F.concat(
            _spans(matches(text, ASSIGN, set_of), lambda m: _let(value(m, ASSIGN), lambda n: F.when(n >= 8, _kind("assign")).when(n >= 4, _kind("short_value")))),
            _spans(matches(text, ACCESS, has("AKIA")), lambda m: F.when(F.length(m) >= 16, _kind("access")).when(F.length(m) >= 8, _kind("short_access"))),
            _spans(matches(text, HEX, F.lit(True)), lambda m: F.when(F.length(m) >= 32, _kind("hex")).otherwise(_kind("short_hex"))),
            _spans(matches(text, LOGIN, set_of), lambda m: F.when(value(m, LOGIN) >= 3, _kind("login"))),
            _spans(matches(text, TOKEN, whole), token),
        )
    )


def _role(kind: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, ROLES.values())), kind + 1)


def link_parts(found: DataFrame, reach: int) -> DataFrame:
    """row_id, linked: the spans of found (row_id, parts) whose complementary parts stand within reach.

    An identifier needs a secret, a secret needs an identifier, an endpoint
    needs both. Weak parts that overlap a strong one are left to it, though they
    may complete others. A part covers the bins of `reach` code points from its
    start to `reach` after its stop; two parts meet where one covers the bin in
    which the other starts. A bin has a bounded number of starts, whatever the
    length of a text or of a part.
    """
    parts = found.select("row_id", F.explode("parts").alias("s")).select("row_id", _role(F.col("s.kind")).alias("role"), "s.start", "s.kind", "s.stop")
    at = F.floor(F.col("start") / reach)
    covered = F.sequence(at, F.floor((F.col("stop") + reach) / reach))

    def bins(df: DataFrame, starts: bool) -> DataFrame:
        """Rows for the bin of the start, which `starts` marks, and for those covered, which its contrary marks."""
        own = F.array(F.struct(at.alias("bin"), F.lit(starts).alias("starts")))
        return df.select("*", F.explode(F.concat(own, F.transform(covered, lambda b: F.struct(b.alias("bin"), F.lit(not starts).alias("starts"))))).alias("b")).select(*df.columns, "b.bin", "b.starts")

    other = bins(parts, False).select("row_id", "bin", "starts", *(F.col(c).alias(f"{c}2") for c in ("role", "start", "kind", "stop")))
    gap = F.greatest("start", "start2") - F.least("stop", "stop2")
    apart, under = (F.col("role") != F.col("role2")) & (gap <= reach), (F.col("kind") >= len(BASE)) & (F.col("kind2") < len(BASE)) & (gap < 0)
    meets = bins(parts, True).join(other, ["row_id", "bin", "starts"]).filter(apart | under)
    has = {r: F.bool_or(apart & (F.col("role2") == r)).alias(f"has_{r}") for r in ("id", "secret")}
    tally = meets.groupBy("row_id", "role", "start", "kind", "stop").agg(*has.values(), F.bool_or(under).alias("under"))
    need = F.when(F.col("role") == "id", F.col("has_secret")).when(F.col("role") == "secret", F.col("has_id")).otherwise(F.col("has_id") & F.col("has_secret"))
    return tally.filter(need & ~F.col("under")).groupBy("row_id").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "stop"))).alias("linked"))


def find_secrets(documents: DataFrame, reach: int = 200, keep: list[str] | None = None) -> DataFrame:
    """row (a struct of the columns in keep, by default all), base, linked and spans: arrays of (start, kind, stop), by start, then kind.

    base are the strong spans, linked those of any kind that stand within reach
    of what completes them, spans both together. kind counts in KINDS; positions
    are code points, the stop exclusive. Null texts are empty. Every row gives
    one row, repeated ones and null ids too; other columns, whatever their
    names, pass in the struct. Only rows that have an identifier and a secret
    are joined.
    """
    found = documents.select(F.monotonically_increasing_id().alias("row_id"), F.struct(*(keep or documents.columns)).alias("row"), all_parts(F.coalesce("text", F.lit(""))).alias("parts"))
    found = materialize(found, "parts")
    base, none = F.filter("parts", lambda s: s["kind"] < len(BASE)), F.array().cast(SPAN)
    both = F.exists("parts", lambda s: _role(s["kind"]) == "id") & F.exists("parts", lambda s: _role(s["kind"]) == "secret")
    joined = found.filter(both).join(link_parts(found.filter(both).select("row_id", "parts"), reach), "row_id", "left")
    joined = joined.select("row", base.alias("base"), F.coalesce("linked", none).alias("linked"))
    out = found.filter(~both).select("row", base.alias("base"), none.alias("linked")).unionByName(joined)
    # linked strong spans are among base already
    return out.withColumn("spans", F.array_sort(F.concat("base", F.filter("linked", lambda s: s["kind"] >= len(BASE)))))


def credentials(span_list: str | Column, reach: int = 200) -> Column:
    """How many credentials sorted linked spans make: spans with gaps of at most reach between them are of one."""
    first = F.struct(F.lit(-1 - (1 << 40)).cast("bigint").alias("stop"), F.lit(0).cast("bigint").alias("n"))
    return F.aggregate(span_list, first, lambda a, s: F.struct(F.greatest(a["stop"], s["stop"]).alias("stop"), (a["n"] + (s["start"] - a["stop"] > reach).cast("int")).alias("n")), lambda a: a["n"])


def spell(span_list: str | Column) -> Column:
    """kind:start:stop, comma-joined."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(span_list, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string"))), ",")


#: A code point has the same number of bytes everywhere in it, so that a place in the text needs no walk.
_FIXED = "UTF-32"


def redact(text: Column, span_list: Column, mask: str = "[redacted]") -> Column:
    """Text with each run of overlapping sorted spans replaced by the mask, in time in proportion to the text and its spans."""

    def cut(x: Column) -> Column:
        wide, spans, reached = x["wide"], x["spans"], x["reached"]
        before = F.concat(F.array(F.lit(0).cast("bigint")), F.slice(reached, F.lit(1), F.size(reached) - 1))

        def part(start: Column, size: Column) -> Column:
            return F.decode(F.substring(wide, (4 * start + 1).cast("int"), (4 * size).cast("int")), _FIXED)

        kept = F.zip_with(spans, before, lambda s, at: F.when(s["start"] >= at, F.concat(part(at, s["start"] - at), F.lit(mask))).otherwise(""))
        last = F.element_at(reached, -1)
        return F.concat(F.array_join(kept, ""), part(last, F.floor(F.length(wide) / 4) - last))

    reached = running(F.transform(span_list, lambda s: s["stop"]), lambda s, x: F.greatest(s, x))
    masked = _let(F.struct(F.encode(text, _FIXED).alias("wide"), span_list.alias("spans"), reached.alias("reached")), cut)
    return F.when(F.size(span_list) > 0, masked).otherwise(text)


def oracle_sql(reach: int = 200) -> str:
    """DuckDB SQL for the rows of op3: all pairs of parts of a document, without bins."""

    def family(pattern: str, kind: str) -> str:
        p = pattern.replace("'", "''")
        cut = f"unnest(regexp_extract_all(t, '{p}')) AS m, unnest(string_split_regex(t, '{p}')[:len(regexp_extract_all(t, '{p}'))]) AS gap, generate_subscripts(regexp_extract_all(t, '{p}'), 1) AS k"
        value = f"length(regexp_extract(m, '{p}', 1))"
        return f"SELECT doc_id, stop - length(m) AS start, stop, {kind.replace('VALUE', value)} AS kind FROM (SELECT doc_id, m, sum(length(gap) + length(m)) OVER (PARTITION BY doc_id ORDER BY k) AS stop FROM (SELECT doc_id, {cut} FROM texts))"

    def k(name: str) -> int:
        return KINDS.index(name)

    token = " ".join(f"WHEN regexp_full_match(m, '{p}') THEN {k(n)}" for p, n in ((SESSION_ID, "session_id"), (MAIL, "mail"), (ENDPOINT, "endpoint")))
    mixed = " AND ".join(f"regexp_matches(m, '{c}')" for c in ("[A-Z]", "[a-z]", "[0-9]")) + f" AND regexp_full_match(m, '{OPAQUE}')"
    families = [
        family(ASSIGN, f"CASE WHEN VALUE >= 8 THEN {k('assign')} WHEN VALUE >= 4 THEN {k('short_value')} END"),
        family(ACCESS, f"CASE WHEN length(m) >= 16 THEN {k('access')} WHEN length(m) >= 8 THEN {k('short_access')} END"),
        family(HEX, f"CASE WHEN length(m) >= 32 THEN {k('hex')} ELSE {k('short_hex')} END"),
        family(LOGIN, f"CASE WHEN VALUE >= 3 THEN {k('login')} END"),
        family(TOKEN, f"CASE {token} WHEN {mixed} THEN {k('opaque')} END"),
    ]
    names = "[" + ", ".join(f"'{x}'" for x in KINDS) + "]"
    roles = "[" + ", ".join(f"'{x}'" for x in ROLES.values()) + "]"
    spelled = f"({names})[kind + 1] || ':' || start || ':' || stop"
    apart = f"a.role <> b.role AND greatest(a.start, b.start) - least(a.stop, b.stop) <= {reach}"
    under = f"a.kind >= {len(BASE)} AND b.kind < {len(BASE)} AND greatest(a.start, b.start) < least(a.stop, b.stop)"
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS ({' UNION ALL '.join(families)}),
parts AS (SELECT doc_id, CAST(start AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop, kind, ({roles})[kind + 1] AS role FROM found WHERE kind IS NOT NULL),
tally AS (
  SELECT a.doc_id, a.start, a.stop, a.kind, a.role, bool_or({apart} AND b.role = 'id') AS has_id, bool_or({apart} AND b.role = 'secret') AS has_secret, bool_or({under}) AS under
  FROM parts a JOIN parts b ON a.doc_id = b.doc_id GROUP BY ALL
), linked AS (
  SELECT doc_id, start, stop, kind FROM tally WHERE NOT under AND CASE role WHEN 'id' THEN has_secret WHEN 'secret' THEN has_id ELSE has_id AND has_secret END
), chained AS (
  SELECT doc_id, coalesce(start - max(stop) OVER (PARTITION BY doc_id ORDER BY start, kind, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > {reach}, true) AS new FROM linked
), heads AS (SELECT doc_id, count(*) AS n_linked, count_if(new) AS n_credentials FROM chained GROUP BY doc_id),
base AS (
  SELECT doc_id, count_if(kind = 0) AS n_assign, count_if(kind = 1) AS n_access, count_if(kind = 2) AS n_hex, string_agg({spelled}, ',' ORDER BY start, kind) AS spelled FROM parts WHERE kind < {len(BASE)} GROUP BY doc_id
), every AS (
  SELECT doc_id, string_agg({spelled}, ',' ORDER BY start, kind) AS spelled FROM (SELECT doc_id, start, stop, kind FROM parts WHERE kind < {len(BASE)} UNION SELECT doc_id, start, stop, kind FROM linked) GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base.spelled, '')) AS base_sha256,
  coalesce(every.spelled, '') AS spans, coalesce(n_linked, 0) AS n_linked, CAST(coalesce(n_credentials, 0) AS BIGINT) AS n_credentials
FROM texts LEFT JOIN base USING (doc_id) LEFT JOIN every USING (doc_id) LEFT JOIN heads USING (doc_id)
"""
