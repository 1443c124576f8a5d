"""Personal data: regular expressions propose spans, checksums confirm them, nearby
context words adjust their score.  DataFrame functions only.

The patterns are linear in the text: a possessive run can only start where no earlier
start would have reached the same end (after a character outside the run, or right after
the previous match), and nothing backtracks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapworks.llm.common import table

# What each kind looks like (Java syntax).
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}+|(?:\x20[A-Z0-9]{4}){2,7}+(?:\x20[A-Z0-9]{1,3}+)?+)(?![A-Za-z0-9])",
}
BASE = ("email", "ip", "card", "phone")
SCORES = {"email": 0.8, "ip": 0.5, "card": 0.7, "phone": 0.5, "iban": 0.8}
CONTEXT = {
    "email": r"(?i)\b(e-?mail|mail|contact|write|address)\b",
    "ip": r"(?i)\b(ip|host|server|address|login)\b",
    "card": r"(?i)\b(card|visa|mastercard|credit|debit|payment)\b",
    "phone": r"(?i)\b(phone|tel|call|mobile|fax|contact)\b",
    "iban": r"(?i)\b(iban|account|bank|transfer)\b",
}
CONTEXT_CHARS = 48
CONTEXT_BONUS = 0.2


def luhn(digits: Column) -> Column:
    """Whether the Luhn sum of a digit string is a multiple of ten."""
    def step(i: Column) -> Column:
        d = F.substr(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = d * 2 - F.when(d > 4, F.lit(9)).otherwise(F.lit(0))
        return F.when(i % 2 == 1, twice).otherwise(d)
    total = F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda acc, i: acc + step(i))
    return total % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether the number an IBAN spells (first four characters last) is 1 modulo 97."""
    s = F.regexp_replace(iban, " ", "")
    s = F.concat(F.substr(s, F.lit(5)), F.substr(s, F.lit(1), F.lit(4)))

    def step(acc: Column, c: Column) -> Column:
        letter = c >= F.lit("A")
        return F.when(letter, acc * 100 + F.ascii(c) - 55).otherwise(acc * 10 + F.ascii(c) - 48) % 97
    return F.aggregate(F.split(s, ""), F.lit(0), lambda acc, c: F.when(c == "", acc).otherwise(step(acc, c))) == 1


def _valid(kind: Column, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    n = F.length(digits)
    small = F.forall(F.split(match, r"\."), lambda p: F.length(F.regexp_replace(p, "^0+", "")) <= 3)
    part = F.forall(F.split(match, r"\."), lambda p: F.coalesce(p.try_cast("int"), F.lit(0)) <= 255)
    return (F.when(kind == "email", F.lit(True))
            .when(kind == "ip", small & part)
            .when(kind == "card", F.when(n.between(16, 19), luhn(digits)).otherwise(F.lit(False)))
            .when(kind == "phone", n.between(8, 15))
            .otherwise(mod97(match)))


def _proposed(text: Column, kind: str) -> Column:
    """Matches of a kind in order: the characters between the one before and it, its
    text, and what stands around it."""
    pattern = F.lit(PATTERNS[kind])
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    between = F.split(text, PATTERNS[kind], -1)
    around = lambda i: F.concat_ws(" ", F.right(F.get(between, i), F.lit(CONTEXT_CHARS)),
                                   F.left(F.get(between, i + 1), F.lit(CONTEXT_CHARS)))
    made = F.transform(found, lambda m, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("i"), F.length(F.get(between, i)).alias("gap"), m.alias("text"),
        F.rlike(around(i), F.lit(CONTEXT[kind])).alias("context")))
    return made


def find(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, spans`` for each row: an array of ``kind, start, end, text, score`` by kind
    (as in ``PATTERNS``), then start; places are code points, the end exclusive.

    Each kind's matches are leftmost and do not overlap; those that fail their check are
    dropped.  Null text: empty.  Null ids and repeated rows: rows as any other.  Other
    columns are not read.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("doc_id"), text.alias("_t"))
    quick = {"email": F.contains("_t", F.lit("@")), "phone": F.contains("_t", F.lit("+")),
             "ip": F.rlike("_t", F.lit(r"[0-9]\.[0-9]")), "card": F.rlike("_t", F.lit(r"[0-9](?:[\x20-]?[0-9]){15}")),
             "iban": F.rlike("_t", F.lit(r"[A-Z]{2}[0-9]{2}[\x20A-Z0-9]"))}
    proposed = F.flatten(F.array(*[F.when(quick[k], _proposed(F.col("_t"), k)).otherwise(F.array()) for k in PATTERNS]))
    spread = rows.select("_row", "doc_id", F.explode_outer(proposed).alias("m")).select("_row", "doc_id", "m.*")
    # a match starts after all gaps up to it and all matches before it
    before = Window.partitionBy("_row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    ends = F.sum(F.col("gap") + F.length("text")).over(before)
    spans = spread.withColumn("end", ends).withColumn("start", F.col("end") - F.length("text"))
    order = F.element_at(F.create_map(*[x for i, k in enumerate(PATTERNS) for x in (F.lit(k), F.lit(i))]), F.col("kind"))
    base = F.element_at(F.create_map(*[x for k, s in SCORES.items() for x in (F.lit(k), F.lit(s))]), F.col("kind"))
    score = F.round(base + F.when(F.col("context"), F.lit(CONTEXT_BONUS)).otherwise(F.lit(0.0)), 2)
    ok = F.col("kind").isNotNull() & _valid(F.col("kind"), F.col("text"))
    span = F.when(ok, F.struct(order.alias("order"), "start", "end", "kind", "text", score.alias("score")))
    return spans.groupBy("_row", "doc_id").agg(F.sort_array(F.collect_list(span)).alias("s")).select(
        "doc_id", F.transform("s", lambda x: F.struct(
            x["kind"].alias("kind"), x["start"].cast("long").alias("start"), x["end"].cast("long").alias("end"),
            x["text"].alias("text"), x["score"].alias("score"))).alias("spans"))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def query(spark, sf_dir):
    found = find(table(spark, sf_dir, "documents"))
    n = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return found.select("doc_id", *[n(k) for k in BASE], F.sha2(_listed(base), 256).alias("base_sha256"),
                        _listed(F.col("spans")).alias("spans"))


def _oracle() -> str:
    plain = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
        "card": r"[0-9](?:[\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
        "iban": r"\b[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)\b",
    }
    digits = "regexp_replace(m, '[^0-9]', '', 'g')"
    luhn_sql = f"""list_sum(list_transform(range(0, length({digits})), lambda i: CASE WHEN i % 2 = 1
        THEN CAST(substr({digits}, length({digits}) - i, 1) AS INT) * 2
             - CASE WHEN CAST(substr({digits}, length({digits}) - i, 1) AS INT) > 4 THEN 9 ELSE 0 END
        ELSE CAST(substr({digits}, length({digits}) - i, 1) AS INT) END)) % 10 = 0"""
    moved = "substr(replace(m, ' ', ''), 5) || substr(replace(m, ' ', ''), 1, 4)"
    number = f"""array_to_string(list_transform(string_split({moved}, ''), lambda c: CASE WHEN c >= 'A'
        THEN CAST(ascii(c) - 55 AS VARCHAR) ELSE c END), '')"""
    checks = {
        "email": "true",
        "ip": """len(list_filter(string_split(m, '.'), lambda p: length(ltrim(p, '0')) > 3
              OR coalesce(TRY_CAST(p AS INT), 0) > 255)) = 0""",
        "card": f"length({digits}) BETWEEN 16 AND 19 AND {luhn_sql}",
        "phone": f"length({digits}) BETWEEN 8 AND 15",
        "iban": f"list_reduce(list_prepend(0, list_transform(string_split({number}, ''), lambda c: CAST(c AS INT))), "
                "lambda a, b: (a * 10 + b) % 97) = 1",
    }
    parts = [f"""SELECT doc_id, {i} AS k, '{kind}' AS kind, m,
    list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(a[1:i - 1], lambda x: length(x))), 0) AS s
    FROM (SELECT doc_id, a, g, unnest(a) AS m, generate_subscripts(a, 1) AS i FROM (
      SELECT doc_id, regexp_extract_all(t, '{p}') AS a, regexp_split_to_array(t, '{p}') AS g FROM d)) WHERE {checks[kind]}"""
             for i, (kind, p) in enumerate(plain.items())]
    say = "kind || ':' || CAST(s AS BIGINT) || ':' || CAST(s + length(m) AS BIGINT)"
    base = ", ".join(f"coalesce(count(*) FILTER (kind = '{k}'), 0) AS n_{k}" for k in BASE)
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
hits AS ({' UNION ALL '.join(parts)})
SELECT d.doc_id, {base},
  sha256(coalesce(string_agg({say}, ',' ORDER BY k, s) FILTER (k < {len(BASE)}), '')) AS base_sha256,
  coalesce(string_agg({say}, ',' ORDER BY k, s), '') AS spans
FROM d LEFT JOIN hits ON hits.doc_id = d.doc_id GROUP BY d.doc_id"""


ORACLE = _oracle()
