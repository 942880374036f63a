"""Text cleaning against hand-made rows and against Python's own regular expressions."""

import html
import re
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tagloom.functions import text as t


def apply(spark, step, *texts):
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, text string")
    return [r[0] for r in rows.orderBy("i").select(step(F.col("text")).alias("x")).collect()]


CASES = [
    (t.mask_users, "hi @вася ok", "hi <USER> ok"),
    (t.mask_emails, "a@b.com", "<EMAIL>"),
    (t.mask_emails, "a@b.com_x@y.org", "<EMAIL><EMAIL>"),
    (t.mask_emails, "nothing here", "nothing here"),
    (t.mask_phones, "call 123456 abc", "call<NUM>abc"),
    (t.mask_ru_phones, "+7 (904) 535 35 35", "<NUM>"),
    (t.mask_digit_runs, "+123456", "+<NUM>"),
    (t.mask_digit_runs, "+1234567", "<NUM>"),
    (t.mask_urls, "WWW.x.org/a b", "<URL> b"),
    (t.plain_punctuation, "«x» — ёЁ", '"x" - еЕ'),
    (t.strip_control, "a​b\u0007c\td\n", "abc\td\n"),
    (t.strip_control, "😀🫠🫶🩷\u0378\ue000\xad\x00é漢", "😀🫠🫶🩷é漢"),
    (t.decode_and_compose, "Привет, мир № ё й", "Привет, мир No ё й"),
    (t.decode_and_compose, "e\u0301 и\u0306 \u1112\u1161\u11ab", "é й 한"),
    (t.strip_tags, "<p>a</p>", " a "),
    (t.strip_tags, "a < b\n> c", "a < b\n> c"),
    (t.decode_and_compose, "a &amp; b", "a & b"),
    (t.decode_and_compose, "ﬁ ＡＢ", "fi AB"),
    (t.collapse_whitespace, "a\n\n  b ", "a b"),
    (t.collapse_whitespace, "a b 　c", "a b c"),
]


@pytest.mark.parametrize("step,text,expected", CASES)
def test_step(spark, step, text, expected):
    assert apply(spark, step, text, None) == [expected, None]


def test_text_that_composition_leaves_alone_stays_in_the_jvm():
    import regex

    escaped = re.sub(r"\\x\{([0-9A-F]+)\}", lambda m: rf"\U{int(m[1], 16):08x}", t._composable())
    trigger = regex.compile(escaped, regex.V1)
    assert not trigger.search("Съешь ещё этих мягких французских булок — «да» 😀 漢字 ß é")
    for point in range(0x110000):
        c = chr(point)
        if not 0xD800 <= point <= 0xDFFF and unicodedata.normalize("NFKC", c) != c:
            assert trigger.match(c), hex(point)


def test_mentions_come_before_emails_unless_asked(spark):
    assert apply(spark, t.clean_text, "a@b.com") == ["a<USER>.com"]
    assert apply(spark, lambda c: t.clean_text(c, email_first=True), "a@b.com") == ["<EMAIL>"]
    assert apply(spark, t.clean_text, "a@-x.com") == ["<EMAIL>"]


def test_missing_text(spark):
    assert apply(spark, t.clean_text, None) == ["None"]
    assert apply(spark, lambda c: t.clean_text(c, keep_null=True), None) == [None]
    assert apply(spark, t.missing_as_nan_text, None, "x") == ["nan", "x"]
    assert apply(spark, lambda c: t.missing_as_nan_text(c, t.MISSING_CELLS), "NA", "nab") == ["nan", "nab"]


def test_flags_and_tokens(spark):
    off = {
        k: False
        for k in "entities nfkc control tags urls users emails phones quotes dashes yo whitespace".split()
    }
    assert apply(spark, lambda c: t.clean_text(c, **off), " <b>ё&amp; ") == [" <b>ё&amp; "]
    assert apply(spark, lambda c: t.clean_text(c, url_token="$1\\"), "see http://x.y") == ["see $1\\"]
    upper = apply(spark, lambda c: t.clean_text(c, repair=F.upper), "abc")
    assert upper == ["ABC"]


def test_blank(spark):
    assert apply(spark, t.is_blank, "", " \n\t", "x", None) == [True, True, False, True]


# The documented meaning of each step, stated with Python's engine.
SEP = r"[\s\-()]*"
PYTHON = {
    t.mask_urls: lambda s: re.sub(r"(?i)https?://\S+|www\.\S+", "<URL>", s),
    t.mask_users: lambda s: re.sub(r"@\w+", "<USER>", s),
    t.mask_emails: lambda s: re.sub(r"[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9.-]+", "<EMAIL>", s),
    t.mask_ru_phones: lambda s: re.sub(SEP.join([r"(?:\+7|8)", r"\d{3}", r"\d{3}", r"\d{2}", r"\d{2}"]), "<NUM>", s),
    t.mask_digit_runs: lambda s: re.sub(rf"(?:(?:\+?\d{{1,3}})?{SEP})?(?:\d{SEP}){{6,}}", "<NUM>", s),
    t.strip_tags: lambda s: re.sub(r"<[^>\n]+>", " ", s),
    t.collapse_whitespace: lambda s: re.sub(r"\s+", " ", s).strip(),
    t.decode_and_compose: lambda s: unicodedata.normalize("NFKC", html.unescape(s)),
}
PIECES = st.sampled_from(
    ["1", "22", "345", "8", "+7", "+", " ", "  ", "-", "(", ")", "a", "b.c", "_", "@", ".", "http://", "www.", "<", ">",
     "\n", "\t", "\xa0", "\u2003", "\u3000", "\u200b", "\u1fff", "\x85", "\x1c", "½", "é", "٣", "ё",
     "&amp;", "&lt;", "ﬁ", "x@y.z", "12 34 56"]
)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(PIECES, max_size=25).map("".join), min_size=150, max_size=150))
def test_steps_agree_with_python(spark, texts):
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, text string")
    steps = list(PYTHON)
    out = rows.select("i", *[step(F.col("text")).alias(step.__name__) for step in steps]).orderBy("i").collect()
    for row, text in zip(out, texts):
        for step in steps:
            assert row[step.__name__] == PYTHON[step](text), (step.__name__, text)


def test_long_runs_stay_linear(spark):
    n = 200_000
    for run in ["1" * n, "- " * n, "a." * n, " " * n, "8 " * n]:
        apply(spark, t.clean_text, run + "@")


def test_nested_class_holds_the_same_characters(spark):
    import random

    rng = random.Random(5)
    points = sorted(rng.sample(range(0x100, 0x3000), 120))
    ranges = [(a, b - 1) for a, b in zip(points[::2], points[1::2])]
    rows = spark.range(0x20, 0x3100).selectExpr("int(id) AS p", "decode(unhex(lpad(hex(id), 4, '0')), 'UTF-16BE') AS c")
    got = {r.p for r in rows.filter(F.col("c").rlike(t._search_class(ranges))).collect()}
    assert got == {p for a, b in ranges for p in range(a, b + 1)}


def test_a_run_of_control_characters_is_one_match(spark):
    """Runs go in one piece, however they are mixed, and new characters between them stay."""
    row = spark.range(1).select(F.lit("a\u200b\x07\xadb\U0001fae0\u200bc\n\t").alias("t"))
    found = row.select(F.regexp_count("t", F.lit(t._control())).alias("n"), t.strip_control(F.col("t")).alias("t")).first()
    assert tuple(found) == (2, "ab\U0001fae0c\n\t")
