"""Golden titles of hygiene, rewrite rules, template values, months, durations and lock levels."""

import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from catalink.functions import text as T

HYGIENE = [
    ("‏תל־אביב", "תל-אביב"),
    ("צה״ל", 'צה"ל'),
    ("ג׳ורג’", "ג'ורג'"),
    ("א   ב ", "א ב"),
    ("é", "é"),
    ("שׁלום", "שׁלום"),
    ("שָׁ", "שָׁ"),
    ("e‎́", "é"),
    ("a―b", "a―b"),
    ("a⁦b", "a⁦b"),
    ("\u001cא\u0085ב", "א ב"),
    (None, None),
    ("", ""),
]
REWRITTEN = [
    ('מקום "קדוש"', "מקום קדוש", "מירכאות_קדוש"),
    ("'קדושים'", "קדושים", "מירכאות_קדוש"),
    ("\"קדושה'", "\"קדושה'", ""),
    ("'\"קדוש\"'", "'קדוש'", "מירכאות_קדוש"),
    ("אלילים", "אלים", "אליל_לאל"),
    ("גאליל", "גאליל", ""),
    ("אלוקים", "אלוהים", "כתיב_אלוהים"),
    ("אלוקינו אלקי", "אלוהינו אלוהי", "כתיב_אלוהים"),
    ("אלקנה", "אלקנה", ""),
    ("באלוקים", "באלוקים", ""),
    ("א-לוהים", "אלוהים", "מקף_שובר"),
    ("א-לוקים", "אלוקים", "מקף_שובר"),
    ("י-ה", "יה", "מקף_שובר"),
    ("ה'תש\"פ", "ה'תש\"ף", "אות_סופית_שנה"),
    ("ה'תש\"ד", "ה'תש\"ד", ""),
    ("ה'תש\"פא", "ה'תש\"פא", ""),
    ('משה (אישיות מהתנ"ך)', "משה (דמות מקראית)", "דמות_מקראית"),
    ("אותו האיש", "ישו", "ישו"),
    ("המרכז הרפורמי", "הבית הכנסת הרפורמי", "מרכז_לבית_כנסת"),
    ("קרבן פסח", "קורבן פסח", "קרבן_לקורבן"),
    ("הקרבן", "הקרבן", ""),
    ("קרבן אלוקים", "קורבן אלוהים", "כתיב_אלוהים+קרבן_לקורבן"),
    ("אלק-ים", "אלוה-ים", "כתיב_אלוהים"),
    ('"אלילים" קרבן', '"אלים" קורבן', "אליל_לאל+קרבן_לקורבן"),
]
TEMPLATES = [
    ("{{מיון ויקיפדיה|דף=[[ישו_הנוצרי]]|x=1}}", "ישו הנוצרי"),
    ("a {{ מיון ויקיפדיה |\n דף = foo  bar }}", "foo bar"),
    ("{{מיון ויקיפדיה|דף= }}", None),
    ("{{מיון ויקיפדיה|דף=\n|q=1}}", None),
    ("none", None),
    (None, None),
]


def column(spark, values, expression):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, x string")
    return [r[0] for r in rows.select(expression.alias("y"), "i").orderBy("i").select("y").collect()]


def test_hygiene(spark):
    assert column(spark, [a for a, _ in HYGIENE], T.hygiene(F.col("x"))) == [b for _, b in HYGIENE]


def test_hygiene_on_random_mixes(spark):
    letters = ["א", "ב", "e", "́", "ָ", "ׁ", "שׁ", "‏", "‮", "״", "’", "–", "־", " ", " ", "\t", "\x1c", "　", "가", "ᄀ", "x"]
    draw = random.Random(3)
    titles = ["".join(draw.choice(letters) for _ in range(draw.randint(0, 9))) for _ in range(3000)]
    table = str.maketrans(T.TRANSLATE_FROM, T.TRANSLATE_TO) | {ord(c): None for c in T.MARKS}
    want = [re.sub(r"\s+", " ", unicodedata.normalize("NFC", t).translate(table)).strip() for t in titles]
    assert column(spark, titles, T.hygiene(F.col("x"))) == want


def test_rules(spark):
    rows = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(REWRITTEN)], "i int, x string")
    got = T.with_rewritten(rows, "x", "text", "applied").orderBy("i").collect()
    assert [(r.text, r.applied) for r in got] == [(b, c) for _, b, c in REWRITTEN]


def test_template_values(spark):
    assert column(spark, [a for a, _ in TEMPLATES], T.template_value(F.col("x"))) == [b for _, b in TEMPLATES]


@pytest.mark.parametrize(("category", "month"), [("ערכים שעודכנו לאחרונה בנובמבר 2023", "2023-11"), ("x", None), ("בשבט 2023", None), (None, None)])
def test_month(spark, category, month):
    assert column(spark, [category], T.month_of(F.col("x"))) == [month]


def test_duration_and_locks(spark):
    assert column(spark, ["0", "59", "61", "3599", "3600", "360061"], T.duration(F.col("x").cast("bigint"))) == ["00:00", "00:59", "01:01", "59:59", "01:00:00", "100:01:01"]
    assert column(spark, [None, "none", "create", "read", "edit"], T.lock_level(F.col("x"))) == ["open", "open", "create_locked", "read_locked", "unknown"]


def test_iso_text(spark):
    rows = spark.createDataFrame([("2024-01-02 03:04:05",), ("2024-01-02 03:04:05.000600",), (None,)], "t string")
    got = [r[0] for r in rows.select(T.iso_text(rows.t.cast("timestamp"))).collect()]
    assert got == ["2024-01-02T03:04:05+00:00", "2024-01-02T03:04:05.000600+00:00", None]
