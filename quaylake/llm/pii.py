"""Personal data: expressions propose spans, checksums confirm them, context words adjust the score."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaylake.llm.common import carried, numbered, position

REACH = 40  # code points on either side in which a context word counts
LEAST = 0.6
CONTEXT = 0.3
SPAN = "array<struct<start:int,rank:int,end:int,kind:string,score:double>>"

LOCAL = "A-Za-z0-9._%+-"
# A run of characters that can open a match is entered only at its beginning or where the last match
# ended, and possessive repeats never go back, so that very long runs cost no more than their length.
# Both leave the leftmost matches as they are.
EMAIL = rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])"
NATIONAL_ID = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
LOCAL_PHONE = r"(?<![0-9+] ?)(?:\([0-9]{3}\) ?|[0-9]{3}[-. ])[0-9]{3}[-. ][0-9]{4}(?![0-9])"


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(text: Column) -> Column:
    """Whether the digits of a text pass Luhn's check: from the right, every second digit doubled."""
    figures = F.transform(F.split(F.reverse(digits(text)), ""), lambda x, i: _luhn_part(F.ascii(x) - 48, i))
    return F.aggregate(figures, F.lit(0), lambda a, x: a + x) % 10 == 0


def _luhn_part(figure: Column, place: Column) -> Column:
    return F.when(place % 2 == 0, figure).when(figure < 5, figure * 2).otherwise(figure * 2 - 9)


def mod97(text: Column) -> Column:
    """Whether an account number passes its check: first four places to the end, letters as 10 to 35."""
    plain = F.replace(text, F.lit(" "), F.lit(""))
    figures = F.transform(
        F.split(F.concat(F.substring(plain, 5, 100), F.substring(plain, 1, 4)), ""), lambda x: F.ascii(x)
    )
    rest = F.aggregate(
        figures, F.lit(0), lambda a, x: F.when(x < 58, (a * 10 + x - 48) % 97).otherwise((a * 100 + x - 55) % 97)
    )
    return rest == 1


def small_parts(text: Column) -> Column:
    """All parts between dots at most 255."""
    def small(part: Column) -> Column:
        bare = F.regexp_replace(part, "^0+", "")
        return F.when(F.length(bare) > 3, False).otherwise(F.concat(F.lit("0"), bare).cast("int") <= 255)

    return F.forall(F.split(text, r"\."), small)


def length_between(low: int, high: int) -> Callable[[Column], Column]:
    return lambda text: F.length(digits(text)).between(low, high)


@dataclass(frozen=True)
class Kind:
    """A kind of personal data. Base kinds are kept whenever they are valid; others need the score."""

    name: str
    pattern: str
    valid: Callable[[Column], Column]
    score: float
    context: str
    base: bool = False


KINDS = (
    Kind("email", EMAIL, lambda x: F.lit(True), 0.9, "mail|email|contact|write", base=True),
    Kind("ip", IP, small_parts, 0.6, "ip|host|server|address|login", base=True),
    Kind("card", CARD, lambda x: F.when(length_between(14, 19)(x), luhn(x)).otherwise(False), 0.8,
         "card|visa|credit|payment|mastercard", base=True),
    Kind("phone", PHONE, length_between(10, 15), 0.7, "phone|tel|call|mobile|fax", base=True),
    Kind("iban", IBAN, mod97, 0.8, "iban|account|bank|bic"),
    Kind("national_id", NATIONAL_ID, lambda x: ~x.rlike("^(000|666|9)|-00-|-0000$"), 0.4, "ssn|social security|id number"),
    Kind("local_phone", LOCAL_PHONE, length_between(10, 10), 0.4, "phone|tel|call|mobile|fax"),
)


def found(body: Column, rank: int) -> Column:
    """Spans of one kind in a text, as structs. The text between the matches gives the places: lengths are
    in code points. Context is cut from the text as it is and lowered then: some letters lower to two."""
    kind = KINDS[rank]
    matches = F.regexp_extract_all(body, F.lit(kind.pattern), F.lit(0))
    between = F.transform(F.split(body, kind.pattern, -1), F.length)
    pairs = F.arrays_zip(F.slice(between, 1, F.size(matches)).alias("gap"), matches.alias("match"))
    empty = F.array().cast("array<struct<start:int,end:int,match:string>>")

    def placed(state: Column, x: Column) -> Column:
        start = state["at"] + x["gap"]
        end = start + F.length(x["match"])
        span = F.struct(start.alias("start"), end.alias("end"), x["match"].alias("match"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(span)).alias("out"))

    spans = F.aggregate(pairs, F.struct(F.lit(0).alias("at"), empty.alias("out")), placed, lambda s: s["out"])
    valid = F.filter(spans, lambda x: kind.valid(x["match"]))

    def scored(x: Column) -> Column:
        start = F.greatest(x["start"] - REACH, F.lit(0))
        near = F.lower(F.substring(body, start + 1, x["end"] + REACH - start))
        score = F.lit(kind.score) + F.when(near.rlike(rf"\b(?:{kind.context})\b"), CONTEXT).otherwise(0.0)
        return F.struct(
            x["start"].alias("start"), F.lit(rank).alias("rank"), x["end"].alias("end"),
            F.lit(kind.name).alias("kind"), F.least(score, F.lit(1.0)).alias("score"),
        )

    none = F.array().cast(SPAN)
    result = F.when(F.size(matches) > 0, F.transform(valid, scored)).otherwise(none)
    return F.when(F.contains(body, F.lit("@")), result).otherwise(none) if kind.name == "email" else result


def marked(rows: DataFrame, body: Column) -> DataFrame:
    """Adds `body`, `base` (spans of the base kinds) and `spans` (all), each by start, then kind."""
    rows = rows.withColumn("body", F.coalesce(body, F.lit("")))
    for rank in range(len(KINDS)):
        rows = rows.withColumn(f"kind_{rank}", found(F.col("body"), rank))
    base = [f"kind_{i}" for i, k in enumerate(KINDS) if k.base]
    more = [f"kind_{i}" for i, k in enumerate(KINDS) if not k.base]
    rows = rows.withColumn("base", F.sort_array(F.concat(*base)))

    def clear(x: Column) -> Column:
        met = F.exists("base", lambda y: (y["start"] < x["end"]) & (x["start"] < y["end"]))
        return (x["score"] >= LEAST) & ~met

    added = F.filter(F.concat(*more), clear)
    return rows.withColumn("spans", F.when(F.size(added) > 0, F.sort_array(F.concat("base", added))).otherwise(F.col("base")))


def as_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def detected(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds `base` and `spans`: arrays of (start, rank, end, kind, score), offsets in code points, end
    exclusive, in order of start and kind.

    Base kinds (email, ip, card, phone) are the leftmost non-overlapping matches of their expression
    that their validator confirms. Others (account numbers by mod 97, national ids, phone numbers
    without a country) join them where their score, raised by context words nearby, is at least LEAST
    and no base span is touched. A null text counts as empty, equal rows are all kept, an input column
    named like an added one is replaced, an empty table gives an empty result.
    """
    rows = marked(numbered(docs), F.col(f"c{position(docs, text)}"))
    return carried(docs, rows, ["base", "spans"])


def redacted(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every span replaced by its kind, as in <EMAIL>; where spans overlap the first names them all.
    Columns as before, null texts stay null; `n_chars`, if there, follows the text."""
    place = position(docs, text)
    rows = marked(numbered(docs), F.col(f"c{place}"))

    def cut(state: Column, x: Column) -> Column:
        new = x["start"] >= state["at"]
        piece = F.concat(
            F.substring(F.col("body"), state["at"] + 1, x["start"] - state["at"]), F.lit("<"), F.upper(x["kind"]), F.lit(">")
        )
        return F.struct(
            F.greatest(state["at"], x["end"]).alias("at"),
            F.when(new, F.concat(state["out"], piece)).otherwise(state["out"]).alias("out"),
        )

    masked = F.aggregate(
        "spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), cut,
        lambda s: F.concat(s["out"], F.substring(F.col("body"), s["at"] + 1, F.length("body"))),
    )
    rows = rows.withColumn("masked", F.when(F.size("spans") > 0, masked).otherwise(F.col(f"c{place}")))
    length = F.length("masked").cast("long")
    named = {place: F.col("masked")} | {i: length for i, c in enumerate(docs.columns) if c.lower() == "n_chars"}
    return rows.select(*[named.get(i, F.col(f"c{i}")).alias(c) for i, c in enumerate(docs.columns)])
