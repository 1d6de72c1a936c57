"""Personal data by regular expressions, checksum validators and context words, in Spark SQL functions only.

Patterns propose spans, leftmost and without overlap within a kind.  Validators (octets, Luhn, mod-97, digit
counts) confirm or drop them.  A span's score starts from its kind and rises when a context word stands nearby;
kinds that digits alone cannot prove need that word.  Quantifiers are possessive and runs are entered at their start
only, so matching takes time in proportion to the text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_DIGITS = "regexp_replace(s.value, '[^0-9]', '')"
_LUHN = (
    "aggregate(sequence(1, length({d})), 0, (acc, i) -> acc + case when i % 2 = 1 then int(substring({d}, -i, 1))"
    " when int(substring({d}, -i, 1)) > 4 then 2 * int(substring({d}, -i, 1)) - 9 else 2 * int(substring({d}, -i, 1)) end) % 10 = 0"
)
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: Letters count 10 to 35, and take two places.
_MOD97 = (
    "aggregate(transform(filter(split(concat(substring({x}, 5), substring({x}, 1, 4)), ''), c -> c <> ''), c -> case when c >= 'A' then ascii(c) - 55 else int(c) end),"
    " 0, (acc, v) -> (acc * case when v > 9 then 100 else 10 end + v) % 97) = 1"
)


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str  # Java regular expression
    gate: str  # texts that do not match this cannot hold the kind
    valid: str = "true"  # SQL over the span ``s``
    score: float = 0.9
    context: str = ""  # words that raise the score
    base: bool = True


#: The four base kinds, then those that the method adds.  Fixed order of the results.
KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", score=0.95),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "[0-9]", f"s.value rlike '^{_OCTET}([.]{_OCTET}){{3}}$'", 0.8, "ip|address|host|server"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9]){15,}+", "[0-9]", f"length({_DIGITS}) between 16 and 19 and {_LUHN.format(d=_DIGITS)}", 0.9, "card|visa|credit|payment"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "[+]", f"length({_DIGITS}) between 8 and 15", 0.75, "phone|tel|call|mobile|fax"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}+(?![A-Za-z0-9])", "[A-Z]{2}[0-9]{2}", "length({x}) between 15 and 34 and {m}".format(x="replace(s.value, ' ', '')", m=_MOD97.format(x="replace(s.value, ' ', '')")), 0.9, "iban|account|bank", False),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "[0-9]-[0-9]", "s.value rlike '^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$'", 0.4, "ssn|social security", False),
    Kind("short_card", r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,14}(?![\x20-]?[0-9])", "[0-9]", _LUHN.format(d=_DIGITS), 0.4, "card|visa|amex|credit|payment", False),
    Kind("local_phone", r"(?<![0-9+.-])(?<![+0-9][\x20(])\(?[0-9]{2,4}\)?[\x20-][0-9]{3,4}[\x20-][0-9]{3,4}(?![0-9-])", "[0-9][ -][0-9]", score=0.3, context="phone|tel|call|mobile|fax", base=False),
)
#: A context word adds this; spans below the threshold are dropped, base kinds never.
CONTEXT_SCORE, THRESHOLD, CONTEXT_CHARS = 0.4, 0.6, 40
#: Matches whose places are summed up in one fold.
CHUNK = 256
_SPAN = "array<struct<kind:string,start:int,end:int,score:double,value:string>>"


def find_pii(df: DataFrame, text_col: str = "text", out: str = "pii") -> DataFrame:
    """Add ``out``: an array of (kind, start, end, score, value), by kind as in ``KINDS`` and then by start.

    Offsets count code points, the end is exclusive.  Null or empty text: an empty array.  All input columns
    stay, whatever their names (one named ``out`` is replaced); repeated rows are treated alike; an empty table stays empty.
    """
    names = df.columns
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    staged = df.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("__row"), text.alias("__text"))
    empty = F.array().cast("array<string>")
    staged = staged.select("*", *(F.when(F.col("__text").rlike(k.gate), F.regexp_extract_all("__text", F.lit(k.pattern), 0)).otherwise(empty).alias(f"m_{k.name}") for k in KINDS))
    staged = staged.select("*", *(F.when(F.size(f"m_{k.name}") > 0, F.split("__text", k.pattern, -1)).alias(f"g_{k.name}") for k in KINDS))
    staged = staged.select("__row", "__text", F.concat(*(F.expr(_spans(k)) for k in KINDS)).alias("__found"))
    return staged.select(*(F.col("__row").getField(c).alias(c) for c in names if c != out), F.col("__found").alias(out))


def _spans(kind: Kind) -> str:
    """Positions from the lengths of matches and of what lies between them; then checks and scores."""
    m, g, none = f"m_{kind.name}", f"g_{kind.name}", f"cast(array() as {_SPAN})"
    # Running sums chunk by chunk: a fold that appends copies what it holds each time
    begun = "aggregate({x}, named_struct('at', {at}, 'out', cast(array() as array<int>)), (acc, n) -> named_struct('at', acc.at + n, 'out', array_append(acc.out, acc.at)), acc -> acc.out)"
    sizes = f"transform(sequence(0, (size({m}) - 1) div {CHUNK}), c -> transform(slice({m}, c * {CHUNK} + 1, {CHUNK}), (x, i) -> length({g}[c * {CHUNK} + i]) + length(x)))"
    chunks = f"transform(array({sizes}), w -> named_struct('sizes', w, 'begun', {begun.format(x='transform(w, x -> aggregate(x, 0, (p, q) -> p + q))', at='0')}))[0]"
    starts = f"transform(array({chunks}), w -> flatten(transform(w.sizes, (x, c) -> {begun.format(x='x', at='w.begun[c]')})))[0]"
    placed = (
        f"transform(array({starts}), at -> transform({m}, (x, i) -> named_struct('kind', '{kind.name}', 'start', at[i] + length({g}[i]), 'end', at[i] + length({g}[i]) + length(x),"
        f" 'score', {kind.score}D, 'value', x)))[0]"
    )
    nearby = f"lower(substring(__text, greatest(1, s.start + 1 - {CONTEXT_CHARS}), s.end - s.start + 2 * {CONTEXT_CHARS})) rlike '(?<![a-z])({kind.context})'"
    score = f"least(1.0D, s.score + case when {nearby} then {CONTEXT_SCORE}D else 0.0D end)" if kind.context else "s.score"
    checked = f"transform(filter({placed}, s -> {kind.valid}), s -> named_struct('kind', s.kind, 'start', s.start, 'end', s.end, 'score', {score}, 'value', s.value))"
    kept = checked if kind.base else f"filter({checked}, s -> s.score >= {THRESHOLD}D)"
    return f"case when size({m}) > 0 then {kept} else {none} end"


def spans_text(spans: str, base_only: bool = False) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    base = ", ".join(f"'{k.name}'" for k in KINDS if k.base)
    chosen = f"filter({spans}, s -> s.kind in ({base}))" if base_only else spans
    return F.expr(f"array_join(transform({chosen}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')")


def redact(df: DataFrame, text_col: str = "text", spans: str = "pii") -> DataFrame:
    """Replace each found span in ``text_col`` by its kind in capitals and brackets; overlapping spans by the first's."""
    ordered = f"array_sort({spans}, (x, y) -> case when x.start <> y.start then x.start - y.start else y.end - x.end end)"
    t = f"`{text_col}`"
    masked = (
        f"aggregate({ordered}, named_struct('at', 0, 'out', ''), (acc, s) -> named_struct('at', greatest(acc.at, s.end), 'out', case when s.start >= acc.at"
        f" then concat(acc.out, substring({t}, acc.at + 1, s.start - acc.at), '[', upper(s.kind), ']') else acc.out end), acc -> concat(acc.out, substring({t}, acc.at + 1)))"
    )
    return df.withColumn(text_col, F.expr(f"case when size({spans}) > 0 then {masked} else {t} end"))
