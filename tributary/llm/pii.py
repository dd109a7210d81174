"""Personal data in text: patterns propose spans, checksums confirm them, context adjusts the score.

Everything is built-in functions. Spark has no function for the places of all matches, so the text is
split at the pattern and lengths are summed up. Patterns are written so that Java matches them in time
proportional to the text and without recursion: a separator that joins two parts is first replaced by
one private character (places stay the same), which turns repeated groups into character classes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.arrays import settled, starts_of

_JOIN = "\ue000"
_LOCAL, _DOMAIN = "A-Za-z0-9._%+-", "A-Za-z0-9-"


@dataclass(frozen=True)
class Kind:
    """``gate``: cheap test of a text; ``subject``: the text as the pattern wants it, ``t`` the text;
    ``valid``: of a match ``m``; ``score`` without context; ``context``: words nearby that add to it."""

    name: str
    gate: str
    subject: str
    pattern: str
    valid: str
    score: float
    context: str
    always: bool = False


_DIGITS = "regexp_replace(m, '[^0-9]', '')"
_LUHN = (
    "pmod(aggregate(sequence(1, length({d})), 0L, (s, i) -> s + "
    "(int(substring(reverse({d}), i, 1)) * (2 - i % 2)) div 10 + (int(substring(reverse({d}), i, 1)) * (2 - i % 2)) % 10), 10) = 0"
).format(d=_DIGITS)
_BARE = f"regexp_replace(m, '[ {_JOIN}]', '')"
# Country and check digits go to the end, letters count 10 to 35.
_MOD97 = (
    f"aggregate(sequence(1, length({_BARE})), 0, (s, i) -> cast(case when substring(substring({_BARE}, 5) || left({_BARE}, 4), i, 1) between '0' and '9' "
    f"then (s * 10 + int(substring(substring({_BARE}, 5) || left({_BARE}, 4), i, 1))) % 97 "
    f"else (s * 100 + ascii(substring(substring({_BARE}, 5) || left({_BARE}, 4), i, 1)) - 55) % 97 end as int)) = 1"
)
_OCTETS = "forall(split(m, '[.]'), o -> length(ltrim('0', o)) <= 3 and coalesce(try_cast(ltrim('0', o) as int), 0) <= 255)"
# Where the text holds that character itself it counts as a sign that stands in no pattern.
_SAFE = f"translate(t, '{_JOIN}', '!')"

#: Characters of an IBAN by country (fixed values).
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}
_IBAN = "|".join(f"(?:{'|'.join(c.split())})[0-9]{{2}}(?:{_JOIN}?[A-Z0-9]){{{n - 4}}}" for n, c in IBAN_LENGTHS.items())

#: In the order of the digest. Context words and scores are parameters of the method.
KINDS = (
    Kind(
        "email", "contains(t, '@')", f"regexp_replace({_SAFE}, '(?<=[{_DOMAIN}])[.](?=[{_DOMAIN}])', '{_JOIN}')",
        rf"(?:\G|(?<![{_JOIN}{_LOCAL}]))[{_JOIN}{_LOCAL}]++@[{_DOMAIN}]++{_JOIN}[{_JOIN}{_DOMAIN}]++", "true", 0.9, "e-?mail|contact|mail|write to", True,
    ),
    Kind("ip", r"t rlike '[0-9][.][0-9]'", "t", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", _OCTETS, 0.7, "ip|address|host|server|login", True),
    Kind(
        "card", r"t rlike '[0-9](?:[ -]?[0-9]){15}'", f"regexp_replace({_SAFE}, '(?<=[0-9])[ -](?=[0-9])', '{_JOIN}')", rf"[0-9][0-9{_JOIN}]+",
        f"length({_DIGITS}) between 16 and 19 and {_LUHN}", 0.8, "card|visa|credit|debit|payment", True,
    ),
    Kind("phone", "contains(t, '+')", "t", r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_DIGITS}) between 8 and 15", 0.6, "tel|phone|call|mobile|fax", True),
    Kind(
        "iban", r"t rlike '[A-Z]{2}[0-9]{2} ?[A-Z0-9]{4} ?[A-Z0-9]{3}'", f"regexp_replace({_SAFE}, '(?<=[A-Z0-9]) (?=[A-Z0-9])', '{_JOIN}')",
        rf"(?<![A-Za-z0-9])(?:{_IBAN})(?![A-Za-z0-9])", _MOD97, 0.8, "iban|bank|account|transfer",
    ),
    Kind("ssn", r"t rlike '[0-9]{3}-[0-9]{2}-[0-9]{4}'", "t", r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])", "true", 0.3, "ssn|social security|taxpayer"),
)
BONUS, LEAST, NEARBY = 0.3, 0.5, 48


def _spans(df: DataFrame, kind: Kind) -> DataFrame:
    """Adds column ``kind.name``: array of (start, stop, score) in order of place."""
    n = kind.name
    gate, subject = F.expr(kind.gate), F.expr(kind.subject)
    none = F.expr("cast(array() as array<string>)")
    df = df.withColumn(f"{n}_m", F.when(gate, F.regexp_extract_all(subject, F.lit(kind.pattern), F.lit(0))).otherwise(none))
    df = df.withColumn(f"{n}_g", F.when(F.size(f"{n}_m") > 0, F.split(subject, kind.pattern, -1)).otherwise(none))
    # Each gap and the match after it.
    df = df.withColumn(f"{n}_l", F.expr(f"transform({n}_m, (m, i) -> length({n}_g[i]) + length(m))"))
    df = df.withColumn(f"{n}_s", F.when(F.size(f"{n}_m") > 0, starts_of(f"{n}_l")).otherwise(F.expr("cast(array() as array<int>)")))
    start = f"{n}_s[i] + length({n}_g[i])"
    near = f"lower(substring(t, greatest(1, {start} + 1 - {NEARBY}), least({NEARBY}, {start}) + length(m) + {NEARBY}))"
    score = f"{kind.score} + if({near} rlike '(?<![a-z])(?:{kind.context})(?![a-z])', {BONUS}, 0)"
    found = f"transform({n}_m, (m, i) -> if({kind.valid}, named_struct('start', {start}, 'stop', {start} + length(m), 'score', double({score})), null))"
    least = "" if kind.always else f" and x.score >= {LEAST}"
    return df.withColumn(n, F.expr(f"filter({found}, x -> x is not null{least})")).drop(*(f"{n}_{x}" for x in "mgls"))


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per input row: the id, ``text`` and for each kind an array of (start, stop, score).

    Places count code points, ends are exclusive. Null text counts as empty. E-mail, IP, card and
    phone spans that pass their check always stay; the other kinds need a score of 0.5, which a
    checksum or a word nearby gives. Other columns are not carried along; rows with the same id, or
    none, are searched each for itself.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    df = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("t"))
    for kind in KINDS:
        df = _spans(df, kind)
    return settled(df.withColumnsRenamed({"id": id_col, "t": "text"}))


def scores_text(kinds: list[str]) -> Column:
    """The score of each span of ``spans_text`` in hundredths, joined likewise."""
    return F.array_join(F.concat(*[F.expr(f"transform({k}, x -> cast(round(100 * x.score) as int))") for k in kinds]), ",")


def spans_text(kinds: list[str]) -> Column:
    """``kind:start:end`` of all spans of the kinds in turn, joined by commas."""
    return F.array_join(F.concat(*[F.expr(f"transform({k}, x -> concat('{k}:', x.start, ':', x.stop))") for k in kinds]), ",")
