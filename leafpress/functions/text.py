"""Column functions that normalise transcript text.  All are null for null, and none needs Python."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Unicode and the transcripts' tools see it.
BLANK = r"(?U)[\s\x1c-\x1f]"
#: Brackets that printed headings stand in; fixed values.
BRACKETS = "〔〕【】[]（）()〈〉《》"
_IN_CLASS = r"〔〕【】\[\]（）()〈〉《》"
#: Chinese digits; fixed values.
CN_DIGITS, CN_VALUES = "零〇一二三四五六七八九两", "001234567892"
_FULL_WIDTH = "０１２３４５６７８９"
#: What brackets start tokens open with and close with.
PAIRS = (("（", "）"), ("(", ")"), ("〔", "〕"), ("[", "]"), ("【", "】"))


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value computed once; keeps nested expressions small."""
    return F.get(F.transform(F.array(value), then), 0)


def strip(c: Column | str) -> Column:
    return F.regexp_replace(_c(c), rf"^{BLANK}+|{BLANK}+$", "")


def norm(c: Column | str) -> Column:
    """Without any white space."""
    return F.regexp_replace(_c(c), rf"{BLANK}+", "")


def norm_key(c: Column | str) -> Column:
    """For lookups only: ``norm`` without the brackets before and the brackets and colons behind."""
    return F.regexp_replace(norm(c), rf"^[{_IN_CLASS}]+|[{_IN_CLASS}：:]+$", "")


def cn_to_int(c: Column | str) -> Column:
    """Digits, or a Chinese numeral from 0 to 99, as int; null if it is neither."""
    one = f"[{CN_DIGITS}]"
    value = lambda x, absent: F.when(x == "", F.lit(absent)).otherwise(F.translate(x, CN_DIGITS, CN_VALUES).try_cast("int"))

    def read(s: Column) -> Column:
        parts = value(F.regexp_extract(s, f"^({one}?)十", 1), 1) * 10 + value(F.regexp_extract(s, f"十({one}?)$", 1), 0)
        return F.when(s.rlike("^[0-9]+$"), s.try_cast("int")).when(s.rlike(f"^{one}?十{one}?$"), parts).when(s.rlike(f"^{one}$"), F.translate(s, CN_DIGITS, CN_VALUES).try_cast("int"))

    return let(F.translate(strip(c), _FULL_WIDTH, "0123456789"), read)


def norm_number_token(c: Column | str) -> Column:
    """Without white space, stars before and separators behind."""
    return F.regexp_replace(norm(c), r"^[*＊]+|[.．、,，:：;；*＊]+$", "")


def accept_number(c: Column | str, style: str, pattern: str) -> Column:
    """Whether a token may number a record in a book of that style (arabic, chinese or mixed)."""
    token = _c(c)
    arabic = token.rlike(f"(?U){pattern}")
    if style == "arabic":
        return arabic & F.translate(token, _FULL_WIDTH, "0123456789").rlike("^[0-9]+$")
    return cn_to_int(token).isNotNull() if style == "chinese" else arabic | cn_to_int(token).isNotNull()


def read_number(c: Column | str, style: str) -> Column:
    token = F.translate(_c(c), _FULL_WIDTH, "0123456789")
    digits = F.when(token.rlike("^[0-9]+$"), token.try_cast("int"))
    return digits if style == "arabic" else F.coalesce(digits, cn_to_int(token))


def parse_start(c: Column | str, style: str, pattern: str) -> Column:
    """struct(raw, number, name, reason) of the text after a start marker; reason ``ok`` if all is there."""
    closed = "^(?:" + "|".join(rf"\{a}([^\{b}]*)\{b}" if a in "([" else f"{a}([^{b}]*){b}" for a, b in PAIRS) + ")(.*)$"
    unclosed = r"(?U)^[（(〔\[]\s*(\S{1,12})\s*(.*)$"
    bare = r"(?U)^(\S{1,12})\s+(.*)$"

    def split(s: Column) -> Column:
        opening = s.rlike(r"^[（(〔\[【]")
        pair = lambda raw, name: F.struct(raw.cast("string").alias("raw"), strip(name).alias("name"))
        inside = F.concat(*(F.regexp_extract(s, closed, k + 1) for k in range(len(PAIRS))))
        found = (
            F.when(s.rlike(closed), pair(inside, F.regexp_extract(s, closed, len(PAIRS) + 1)))
            .when(opening & s.rlike(unclosed), pair(F.regexp_extract(s, unclosed, 1), F.regexp_extract(s, unclosed, 2)))
            .when(opening, pair(F.lit(None), F.lit("")))
            .when(s.rlike(bare), pair(F.regexp_extract(s, bare, 1), F.regexp_extract(s, bare, 2)))
            .otherwise(pair(s, F.lit("")))
        )
        return F.struct((s == "").alias("empty"), found.alias("f"))

    def judge(x: Column) -> Column:
        raw, name, token, number = (x[n] for n in ("raw", "name", "token", "number"))
        reason = F.when(x["empty"], "empty").when(raw.isNull(), "no-token").when(~accept_number(token, style, pattern), "unnumbered").when(number.isNull(), "number-unreadable").when(name == "", "no-name").otherwise("ok")
        return F.struct(raw.alias("raw"), number.alias("number"), name.alias("name"), reason.alias("reason"))

    def read(x: Column) -> Column:
        return let(norm_number_token(x["f"]["raw"]), lambda t: F.struct(x["empty"].alias("empty"), x["f"]["raw"].alias("raw"), x["f"]["name"].alias("name"), t.alias("token"), read_number(t, style).alias("number")))

    cleaned = F.regexp_replace(strip(c), rf"^[*＊]{BLANK}*", "")
    return let(let(let(cleaned, split), read), judge)


def may_number(c: Column | str) -> Column:
    """Whether a stripped text may be read as a start: ``parse_start`` gives no number where a text does not begin with one, stars and one bracket aside."""
    blank = rf"[*＊\s\x1c-\x1f]*"
    return _c(c).rlike(rf"(?U)^{blank}[（(〔\[【]?{blank}[0-9{_FULL_WIDTH}{CN_DIGITS}十]")


def lookup(c: Column, table: dict[str, str]) -> Column:
    """The value of a small fixed table, null if it has none."""
    return F.try_element_at(F.create_map(*(F.lit(x) for kv in table.items() for x in kv)), c)


def inline_section(c: Column | str, table: dict[str, str]) -> Column:
    """struct(section, rest) of ``〔name〕 rest`` with a registered name; section null otherwise."""
    pattern = r"(?U)^\s*[〔\[【]\s*([^〕\]】]{1,10}?)\s*[〕\]】]\s*(.*)$"
    return F.struct(lookup(norm_key(F.regexp_extract(_c(c), pattern, 1)), table).alias("section"), strip(F.regexp_extract(_c(c), pattern, 2)).alias("rest"))


def bare_group(c: Column | str, groups: dict[str, str]) -> Column:
    """struct(group, value) of ``name：value`` on the line without blanks, the first registered name winning; null otherwise."""

    def match(t: Column) -> Column:
        return F.coalesce(*(F.when(t.startswith(p + sep), F.struct(F.lit(g).alias("group"), F.substring(t, len(p) + 2, 1_000_000).alias("value"))) for p, g in groups.items() for sep in "：:"))

    return let(norm(c), match)


def bare_step(c: Column | str, patterns: Sequence[str]) -> Column:
    """struct(marker, rest) by the first pattern that matches; null otherwise."""

    def match(s: Column) -> Column:
        return F.coalesce(*(F.when(s.rlike(f"(?U){p}"), F.struct(strip(F.regexp_extract(s, f"(?U)({p})", 1)).alias("marker"), strip(F.regexp_replace(s, f"(?U){p}", "")).alias("rest"))) for p in patterns))

    return let(strip(c), match)


def glossary_entry(c: Column | str, pattern: str) -> Column:
    """struct(marker, title, text) by a pattern with three groups; null if it does not match."""
    s = _c(c)
    return F.when(s.rlike(pattern), F.struct(*(F.regexp_extract(s, pattern, k).alias(n) for k, n in ((1, "marker"), (2, "title"), (3, "text")))))


def bigrams(c: Column | str) -> Column:
    """Distinct pairs of adjacent characters of the normalised text; of a shorter text, that text."""
    t = norm(c)
    return F.when(F.length(t) < 2, F.array(t)).otherwise(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(t) - 1), lambda i: F.substring(t, i, F.lit(2)))))


def card_text(name: Column, chapter: Column, ingredients: Column, seasonings: Column) -> Column:
    none = lambda a: F.when(F.size(a) > 0, F.array_join(a, "、")).otherwise("无")
    return F.concat(name, F.lit("（"), F.coalesce(F.nullif(chapter, F.lit("")), F.lit("未分章")), F.lit("）主料："), none(ingredients), F.lit("；调料："), none(seasonings))


def scope_code(c: Column | str) -> Column:
    return F.regexp_extract(_c(c), r"(?U)^\s*(\S*)", 1)


def strip_watermark(c: Column | str, literals: Iterable[str]) -> Column:
    """struct(text, sha256 of the original, literals present): without the literals, emptied brackets and doubled blanks."""
    text, hits = _c(c), F.lit(0)
    for x in literals:
        hits = hits + F.when(F.contains(_c(c), F.lit(x)), 1).otherwise(0)
        text = F.replace(text, F.lit(x), F.lit(""))
    text = F.regexp_replace(text, r"\(\s*\)|\[\s*\]|（\s*）|【\s*】", "")
    text = F.regexp_replace(F.regexp_replace(text, r"\s{2,}", " "), r"\s+([.)\]])", "$1")
    return F.struct(strip(text).alias("text"), F.sha2(_c(c), 256).alias("sha256"), hits.alias("literals"))


def witness_name(c: Column | str) -> Column:
    """A name as a witness gives it: no parentheses, what follows ``=``, three CJK characters at least; else null."""
    s = F.regexp_replace(_c(c), r"（[^）]*）|\([^)]*\)", "")
    s = norm(F.when(F.contains(s, F.lit("=")), F.regexp_extract(s, r"(?s)=(.*)$", 1)).otherwise(s))
    return F.when(s.rlike(r"^[㐀-鿿\x{20000}-\x{3FFFF}]{3,}$"), s)


def one_char_diff(a: Column, b: Column) -> Column:
    """struct(x, y) of the only position where two strings of one length differ; null otherwise."""
    pairs = F.filter(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: F.struct(x.alias("x"), y.alias("y"))), lambda p: p["x"] != p["y"])
    return F.when((F.length(a) == F.length(b)) & (F.size(pairs) == 1), F.get(pairs, 0))


def count_literal(c: Column | str, literal: str) -> Column:
    return ((F.length(_c(c)) - F.length(F.replace(_c(c), F.lit(literal), F.lit("")))) / len(literal)).cast("int")
