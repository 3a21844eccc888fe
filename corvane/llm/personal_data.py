"""Personal data, natively: regular expressions propose spans, checksums confirm, context adjusts.

Everything is a SQL expression of the scan: no shuffle, no Python. A kind's matches come from
`regexp_extract_all` and the gaps between them from `split` by the same pattern; their lengths
give the offsets in code points.

The patterns are linear on any text: each starts only where a run of its characters starts or
where the last match ended (`\\G`), and repeats possessively, which finds just the matches of the
plain patterns in `PLAIN`, leftmost and non-overlapping. A card pattern reads whole digit runs and
takes only those of 12 to 19 digits, as shorter or longer ones would be dropped anyway.

So is the rest, however many spans a text has. Arrays can't grow in place, so running offsets are
summed in two levels: `BLOCK` matches at a time, and the blocks' sums. And a string has no index, so
context and the text between spans are taken from `CHUNK` code points at a time, an array of which
is made once per text.

Base kinds (email, ip, card, phone) need their check and stay whatever their score. Added kinds
are IBANs, confirmed by the mod-97 checksum, and US social security numbers, which have no
checksum and count only beside a context word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.sources.tables import table

# The plain patterns and, in `PATTERNS`, equivalents without backtracking.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b",
    "ssn": r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
}
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])",
    "phone": PLAIN["phone"],
    "iban": r"(?<![A-Za-z0-9_])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9_])",
    "ssn": r"(?<![A-Za-z0-9_])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9_])",
}
KINDS = tuple(PATTERNS)
BASE = KINDS[:4]
#: Score of a confirmed span, what a context word adds, and what an added kind must reach.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "ssn": 0.3}
CONTEXT_GAIN, ENOUGH = 0.3, 0.6
CONTEXT = {
    "email": "mail|contact",
    "ip": "ip|address|host|server",
    "card": "card|visa|credit|pay",
    "phone": "phone|tel|call|mobile|fax",
    "iban": "iban|bank|account|konto",
    "ssn": "ssn|social security",
}
#: Code points before and after a span that are searched for context words.
REACH = 40
#: A text without this character has no match of the kind.
NEEDS = {"email": "@", "ip": ".", "phone": "+", "ssn": "-"}

OCTET = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
ALPHABET = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"

SPAN = "array<struct<start:int,no:int,stop:int,score:double>>"
#: Matches of one block of running sums, and code points of one chunk of a text.
BLOCK, CHUNK = 256, 1024


def in_blocks(array: Column) -> Column:
    """Numbers of the blocks of a non-empty array."""
    return F.sequence(F.lit(0), ((F.size(array) - 1) / BLOCK).cast("int"))


def block_of(array: Column, number: Column) -> Column:
    return F.slice(array, number * BLOCK + 1, F.lit(BLOCK))


def running(values: Column, merge) -> Column:
    """For each of the values, a 0 merged with all values before it."""
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
    step = lambda s, v: F.struct(merge(s["at"], v).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out"))
    return F.aggregate(values, begin, step, lambda s: s["out"])


def piece(chunks: Column, start: Column, stop: Column) -> Column:
    """Code points [start, stop) of the text that was cut into chunks."""
    first, last = (start / CHUNK).cast("int"), (stop / CHUNK).cast("int")
    head = F.coalesce(F.get(chunks, first), F.lit(""))
    tail = F.substring(F.coalesce(F.get(chunks, last), F.lit("")), F.lit(1), stop - last * CHUNK)
    between = F.array_join(F.slice(chunks, first + 2, last - first - 1), "")
    from_head = F.substring(head, start - first * CHUNK + 1, F.least(stop - start, F.lit(CHUNK)))
    return F.when(first == last, from_head).otherwise(F.concat(from_head, between, tail))


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    turned = F.reverse(digits)

    def add(total: Column, place: Column) -> Column:
        value = F.substring(turned, place, F.lit(1)).cast("int")
        doubled = value * 2 - F.when(value > 4, 9).otherwise(0)
        return total + F.when(place % 2 == 0, doubled).otherwise(value)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an IBAN without blanks has the remainder 1."""
    turned = F.concat(F.substring(account, F.lit(5), F.length(account)), F.substring(account, 1, 4))

    def step(rest: Column, place: Column) -> Column:
        value = F.instr(F.lit(ALPHABET), F.substring(turned, place, F.lit(1))) - 1
        return (rest * F.when(value > 9, 100).otherwise(10) + value) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(account)), F.lit(0), step) == 1


def confirmed(kind: str, found: Column) -> Column:
    digits = F.regexp_replace(found, "[^0-9]", "")
    if kind == "ip":
        return found.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        return F.length(digits).between(12, 19) & luhn(digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    if kind == "iban":
        return mod97(F.replace(found, F.lit(" "), F.lit("")))
    return F.lit(True)


def kind_spans(kind: str, pairs: Column, begins: Column, chunks: Column) -> Column:
    """The confirmed spans of a kind; pairs are its matches and the gaps before them, begins the offsets of their blocks."""
    empty = F.array().cast(SPAN)

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + pair["gap"]
        stop = start + F.length(pair["x"])
        near = F.lower(F.concat_ws(" ", piece(chunks, F.greatest(start - REACH, F.lit(0)), start), piece(chunks, stop, stop + REACH)))
        score = F.lit(PRIOR[kind]) + F.when(near.rlike(rf"(?:{CONTEXT[kind]})"), CONTEXT_GAIN).otherwise(0.0)
        span = F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("no"), stop.alias("stop"), F.least(score, F.lit(1.0)).alias("score"))
        good = confirmed(kind, pair["x"])
        if kind not in BASE:
            good = good & (score >= ENOUGH)
        return F.struct(stop.alias("at"), F.when(good, F.concat(state["out"], F.array(span))).otherwise(state["out"]).alias("out"))

    def block(number: Column) -> Column:
        begin = F.struct(F.get(begins, number).alias("at"), empty.alias("out"))
        return F.aggregate(block_of(pairs, number), begin, step, lambda state: state["out"])

    some = (F.size(pairs) > 0) & (F.size(begins) > 0)
    return F.when(some, F.flatten(F.transform(in_blocks(pairs), block))).otherwise(empty)


def with_spans(documents: DataFrame) -> tuple[DataFrame, str, str, str]:
    """`documents` with the text (null as empty), its chunks and its spans, sorted by start and kind, and the names of these three columns.

    New columns begin with one underscore more than any that the table has. What lambdas use is a
    column of its own that is used twice or more, as the optimizer would inline it into them otherwise.
    """
    mark = "_" * (1 + max(len(c) - len(c.lstrip("_")) for c in documents.columns))
    text = F.col(mark + "text")
    frame = documents.withColumn(mark + "text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    found = {}
    for kind in KINDS:
        matches = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))
        if kind in NEEDS:
            matches = F.when(F.contains(text, F.lit(NEEDS[kind])), matches).otherwise(F.array().cast("array<string>"))
        found[mark + kind] = matches
    frame = frame.withColumns(found)

    def paired(kind: str) -> Column:
        one = F.col(mark + kind)
        gaps = F.slice(F.split(text, PATTERNS[kind], -1), F.lit(1), F.size(one))
        pairs = F.zip_with(gaps, one, lambda gap, x: F.struct(F.length(gap).alias("gap"), x.alias("x")))
        return F.when(F.size(one) > 0, pairs).otherwise(F.array().cast("array<struct<gap:int,x:string>>"))

    some = sum(F.size(mark + kind) for kind in KINDS) > 0
    chunks = F.when(some, F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))).otherwise(F.array().cast("array<string>"))
    frame = frame.withColumns({mark + "chunks": chunks} | {mark + kind + "_pairs": paired(kind) for kind in KINDS})

    def begins(kind: str) -> Column:
        pairs = F.col(mark + kind + "_pairs")
        total = lambda number: F.aggregate(block_of(pairs, number), F.lit(0), lambda t, p: t + p["gap"] + F.length(p["x"]))
        summed = running(F.transform(in_blocks(pairs), total), lambda at, v: at + v)
        return F.when(F.size(pairs) > 0, summed).otherwise(F.array().cast("array<int>"))

    frame = frame.withColumns({mark + kind + "_begins": begins(kind) for kind in KINDS})
    each = (kind_spans(kind, F.col(mark + kind + "_pairs"), F.col(mark + kind + "_begins"), F.col(mark + "chunks")) for kind in KINDS)
    frame = frame.withColumn(mark + "spans", F.array_sort(F.concat(*each)))
    own = (mark + "text", mark + "chunks", mark + "spans")
    return frame.select(*(f"`{c}`" for c in documents.columns), *own), *own


def personal_data(documents: DataFrame) -> DataFrame:
    """doc_id, counts by kind, base_sha256 and spans for each row of `documents`.

    A null or empty text has no spans (the hash is that of the empty string). Of spans with equal
    starts the kind listed first comes first. Repeated rows are judged each for itself; other
    columns are not looked at. n_iban, n_ssn and scores (in the order of spans) follow.
    """
    frame, _, _, name = with_spans(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    spans = F.col(name)
    names = F.array(*(F.lit(k) for k in KINDS))

    def joined(array: Column) -> Column:
        return F.array_join(
            F.transform(array, lambda s: F.concat_ws(":", F.get(names, s["no"]), s["start"].cast("string"), s["stop"].cast("string"))), ","
        )

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["no"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    return frame.select(
        "doc_id",
        *(count(kind) for kind in BASE),
        F.sha2(joined(F.filter(spans, lambda s: s["no"] < len(BASE))).cast("binary"), 256).alias("base_sha256"),
        joined(spans).alias("spans"),
        *(count(kind) for kind in KINDS if kind not in BASE),
        F.array_join(F.transform(spans, lambda s: F.round(s["score"] * 10).cast("int").cast("string")), ",").alias("scores"),
    )


def redact(documents: DataFrame) -> DataFrame:
    """`documents` with every span replaced by its kind, as <EMAIL>, and n_chars counted anew.

    Overlapping spans become one, named by the first. Texts without spans, null ones included,
    stay as they are; n_chars is changed only where the column exists and spans were found.
    Repeated rows are changed alike, and an empty table stays empty.
    """
    columns = documents.columns
    frame, text_name, chunks_name, spans_name = with_spans(documents)
    text, chunks, spans, clean = F.col(text_name), F.col(chunks_name), F.col(spans_name), text_name + "_clean"
    marks = F.array(*(F.lit(f"<{k.upper()}>") for k in KINDS))
    stops = F.transform(in_blocks(spans), lambda number: F.array_max(F.transform(block_of(spans, number), lambda s: s["stop"])))
    reached = text_name + "_reached"
    frame = frame.withColumn(reached, F.when(F.size(spans) > 0, running(stops, F.greatest)))
    begins = F.col(reached)

    def step(state: Column, s: Column) -> Column:
        more = F.concat(state["out"], F.array(piece(chunks, state["at"], s["start"]), F.get(marks, s["no"])))
        return F.struct(F.greatest(state["at"], s["stop"]).alias("at"), F.when(s["start"] >= state["at"], more).otherwise(state["out"]).alias("out"))

    def block(number: Column) -> Column:
        begin = F.struct(F.get(begins, number).alias("at"), F.array().cast("array<string>").alias("out"))
        return F.aggregate(block_of(spans, number), begin, step, lambda state: F.array_join(state["out"], ""))

    last = F.array_max(F.transform(spans, lambda s: s["stop"]))
    rest = F.substring(text, last + 1, F.length(text))
    built = F.concat(F.array_join(F.transform(in_blocks(spans), block), ""), rest)
    frame = frame.withColumn(clean, F.when((F.size(spans) > 0) & (F.size(begins) > 0), built))
    changed = {"text": F.coalesce(clean, "text")}
    if "n_chars" in columns:
        changed["n_chars"] = F.coalesce(F.length(clean).cast(documents.schema["n_chars"].dataType), F.col("n_chars"))
    return frame.withColumns(changed).select(*(f"`{c}`" for c in columns))


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


def _kind_sql(kind: str) -> str:
    digits = "regexp_replace(x, '[^0-9]', '', 'g')"
    luhn_sql = (
        f"list_sum(list_transform(range(1, len({digits}) + 1), lambda i: CASE WHEN i % 2 = 0 THEN "
        f"CAST(substr(reverse({digits}), CAST(i AS BIGINT), 1) AS INT) * 2 - CASE WHEN CAST(substr(reverse({digits}), CAST(i AS BIGINT), 1) AS INT) > 4 THEN 9 ELSE 0 END "
        f"ELSE CAST(substr(reverse({digits}), CAST(i AS BIGINT), 1) AS INT) END)) % 10 = 0"
    )
    account = "replace(x, ' ', '')"
    turned = f"(substr({account}, 5) || substr({account}, 1, 4))"
    check = {
        "email": "true",
        "ip": f"regexp_full_match(x, '{OCTET}(?:\\.{OCTET}){{3}}')",
        "card": f"len({digits}) BETWEEN 12 AND 19 AND {luhn_sql}",
        "phone": f"len({digits}) BETWEEN 9 AND 15",
        "iban": f"list_reduce(list_prepend(0, list_transform(string_split({turned}, ''), lambda c: instr('{ALPHABET}', c) - 1)), "
        "lambda a, b: (a * CASE WHEN b > 9 THEN 100 ELSE 10 END + b) % 97) = 1",
        "ssn": "true",
    }[kind]
    if kind not in BASE:
        check += f" AND {PRIOR[kind]} + CASE WHEN context THEN {CONTEXT_GAIN} ELSE 0 END >= {ENOUGH}"
    return f"""
  SELECT r, {KINDS.index(kind)} AS no, '{kind}' AS kind, start, start + length(x) AS stop,
    CAST(round(least({PRIOR[kind]} + CASE WHEN context THEN {CONTEXT_GAIN} ELSE 0 END, 1.0) * 10) AS INT) AS score
  FROM (
    SELECT *, regexp_matches(lower(substr(t, greatest(start - {REACH}, 0) + 1, start - greatest(start - {REACH}, 0)) || ' ' || substr(t, start + length(x) + 1, {REACH})), '{CONTEXT[kind]}') AS context
    FROM (
      SELECT r, t, x, CAST(sum(length(gap)) OVER w + coalesce(sum(length(x)) OVER (PARTITION BY r ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
      FROM (
        SELECT r, t, unnest(regexp_extract_all(t, '{PLAIN[kind]}')) AS x, unnest(list_slice(string_split_regex(t, '{PLAIN[kind]}'), 1, -2)) AS gap,
          unnest(range(1, len(regexp_extract_all(t, '{PLAIN[kind]}')) + 1)) AS k
        FROM doc WHERE regexp_matches(t, '{PLAIN[kind]}'))
      WINDOW w AS (PARTITION BY r ORDER BY k)))
  WHERE {check}"""


SQL = f"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
span AS ({" UNION ALL ".join(map(_kind_sql, KINDS))}),
joined AS (
  SELECT r, {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in KINDS)},
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, no) AS spans,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, no) FILTER (no < {len(BASE)}) AS base,
    string_agg(CAST(score AS VARCHAR), ',' ORDER BY start, no) AS scores
  FROM span GROUP BY r)
SELECT doc_id, {", ".join(f"CAST(coalesce(n_{k}, 0) AS BIGINT) AS n_{k}" for k in KINDS)},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(scores, '') AS scores
FROM doc LEFT JOIN joined USING (r)
"""
