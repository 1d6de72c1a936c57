from pyspark.sql import functions as F

from leafpress.functions import text as T
from leafpress.operators.contract import Contract


def values(spark, rows, *columns):
    return [tuple(r) for r in spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a string, b string").orderBy("i").select(*columns).collect()]


def one(spark, texts, column):
    return [r[0] for r in values(spark, [(t, None) for t in texts], column)]


def test_norm_and_key(spark):
    assert one(spark, ["a　b \u2028c\x1c", "", None], T.norm("a")) == ["abc", "", None]
    assert one(spark, ["〔主 料〕：", "（a）b", None], T.norm_key("a")) == ["主料", "a）b", None]


def test_numerals(spark):
    assert one(spark, ["十", "二十", "两", "〇", "九十九", "12", "４", "二十八", "百", "", None], T.cn_to_int("a")) == [10, 20, 2, 0, 99, 12, 4, 28, None, None, None]


def test_start_tokens(spark):
    texts = ["（二 十 八） 甲", "2. 甲", "1.* 甲", "(五)甲", "〔二〕 甲", "*（六） 甲", "甲（又名）", "（三", "", "（四）"]
    c = Contract()
    found = one(spark, texts, T.parse_start("a", c.number_style, c.recipe_number_pattern))
    assert [(r["number"], r["reason"]) for r in found] == [(28, "ok"), (2, "ok"), (1, "ok"), (5, "ok"), (2, "ok"), (6, "ok"), (None, "unnumbered"), (3, "no-name"), (None, "empty"), (4, "no-name")]


def test_sections_groups_steps_glossary(spark):
    c = Contract()
    assert [tuple(r) for r in one(spark, ["〔调料〕 盐", "〔特点〕 x", "盐"], T.inline_section("a", c.section_keys()))] == [("seasoning", "盐"), (None, "x"), (None, "")]
    assert one(spark, ["主 料：甲 乙", "配料:x", "x"], T.bare_group("a", c.group_keys()))[:2] == [("main", "甲乙"), ("side", "x")]
    assert one(spark, ["（1） x", "2. y", "z"], T.bare_step("a", c.step_number_patterns)) == [("（1）", "x"), ("2.", "y"), None]
    assert one(spark, ["①火候：要旺", "x"], T.glossary_entry("a", c.glossary_pattern)) == [("①", "火候", "要旺"), None]


def test_witnesses_and_bigrams(spark):
    assert one(spark, ["A=甲乙丙（x）", "甲丁 丙", "ab", None], T.witness_name("a")) == ["甲乙丙", "甲丁丙", None, None]
    assert [r[0] and tuple(r[0]) for r in values(spark, [("甲乙丙", "甲丁丙"), ("甲乙", "丙丁"), ("a", "ab")], T.one_char_diff(F.col("a"), F.col("b")))] == [("乙", "丁"), None, None]
    assert [sorted(x) if x else x for x in one(spark, ["aba b", "鱼", "", None], T.bigrams("a"))] == [["ab", "ba"], ["鱼"], [""], None]
