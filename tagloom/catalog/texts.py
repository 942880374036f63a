"""Queries on text cleaning, lemmas and entities."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagloom.catalog.registry import query
from tagloom.catalog.views import table, texts
from tagloom.functions import text as ops
from tagloom.operators.lemma_rules import learn_rules, lemmatize_all
from tagloom.operators.lexicon import TOKEN, extract_entities, lemmatize, tokens

# RE2 spellings of the Unicode classes; RE2 runs in linear time and needs no possessive quantifiers.
RE2_SPACE = r"\s\x0b\x1c-\x1f\x{85}\p{Z}"
RE2_SEPARATOR = RE2_SPACE + r"\-()"
RE2 = {
    "urls": (rf"(?i)(https?://[^{RE2_SPACE}]+|www\.[^{RE2_SPACE}]+)", "<URL>"),
    "users": (r"@[\p{L}\p{N}_]+", "<USER>"),
    "emails": (r"[a-zA-Z0-9_.+\-]+@[a-zA-Z0-9\-]+\.[a-zA-Z0-9\-.]+", "<EMAIL>"),
    "ru_phones": (
        rf"(?:\+7|8)[{RE2_SEPARATOR}]*\p{{Nd}}{{3}}[{RE2_SEPARATOR}]*\p{{Nd}}{{3}}"
        rf"[{RE2_SEPARATOR}]*\p{{Nd}}{{2}}[{RE2_SEPARATOR}]*\p{{Nd}}{{2}}",
        "<NUM>",
    ),
    "digit_runs": (
        rf"(?:(?:\+?\p{{Nd}}{{1,3}})?[{RE2_SEPARATOR}]*)?(?:\p{{Nd}}[{RE2_SEPARATOR}]*){{6,}}",
        "<NUM>",
    ),
    "tags": (r"<[^>\n]+>", " "),
    "control": (r"[^\P{C}\n\t]", ""),
    "whitespace": (rf"[{RE2_SPACE}]+", " "),
}
PLAIN = ops.DOUBLE_QUOTES + ops.SINGLE_QUOTES + ops.DASHES + ops.YO
PLAIN_TO = '"' * len(ops.DOUBLE_QUOTES) + "''" * len(ops.SINGLE_QUOTES) + "-" * len(ops.DASHES) + ops.YE


def replaced(column: str, *steps: str) -> str:
    for step in steps:
        if step == "punctuation":
            column = f"translate({column}, '{PLAIN}', '{PLAIN_TO}')"
        else:
            pattern, token = RE2[step]
            column = f"regexp_replace({column}, '{pattern}', '{token}', 'g')"
            if step == "whitespace":
                column = f"trim({column})"
    return column


def documents(spark, sf):
    return texts(spark, sf, "documents", "doc_id", "text")


def pages(spark, sf):
    return texts(spark, sf, "pages", "page_id", "url", "html").select("page_id", F.concat_ws(" ", "url", "html").alias("text"))


DOCUMENTS = "SELECT doc_id, {} AS text FROM documents"
PAGES = "SELECT page_id, {} AS text FROM (SELECT page_id, concat_ws(' ', url, html) AS text FROM pages)"

for _name, _source, _sql, _step, _steps in [
    ("mask_urls", pages, PAGES, ops.mask_urls, ["urls"]),
    ("mask_users", documents, DOCUMENTS, ops.mask_users, ["users"]),
    ("mask_emails", documents, DOCUMENTS, ops.mask_emails, ["emails"]),
    ("mask_ru_phones", documents, DOCUMENTS, ops.mask_ru_phones, ["ru_phones"]),
    ("mask_phones", documents, DOCUMENTS, ops.mask_phones, ["ru_phones", "digit_runs"]),
    ("mask_page_phones", pages, PAGES, ops.mask_phones, ["ru_phones", "digit_runs"]),
    ("plain_punctuation", pages, PAGES, ops.plain_punctuation, ["punctuation"]),
    ("strip_control", documents, DOCUMENTS, ops.strip_control, ["control"]),
    ("strip_tags", pages, PAGES, ops.strip_tags, ["tags"]),
    ("collapse_whitespace", documents, DOCUMENTS, ops.collapse_whitespace, ["whitespace"]),
]:

    def _rewrite(spark, sf, source=_source, step=_step):
        rows = source(spark, sf)
        return rows.withColumn("text", step(F.col("text")))

    query(_name, _sql.format(replaced("text", *_steps)))(_rewrite)


# Rows that hold what a step is for, planted by the same expression on both sides.
CONTROL_PLANTED = "replace(text, 'e', 'e' || {0}(8203) || {0}(7) || '\U0001fae0' || {0}(173))"
QUOTES_PLANTED = "replace(replace(text, ' th', ' «th» – „ё’'), 'a', 'аЁ')"


@query("strip_control_planted", DOCUMENTS.format(replaced(CONTROL_PLANTED.format("chr"), "control")))
def strip_control_planted(spark, sf):
    """Control and format characters go, a new emoji stays."""
    planted = F.expr(CONTROL_PLANTED.format("char").replace("char(8203)", "'\u200b'").replace("char(173)", "'\xad'"))
    return documents(spark, sf).withColumn("text", ops.strip_control(planted))


@query("plain_punctuation_planted", DOCUMENTS.format(replaced(QUOTES_PLANTED, "punctuation")))
def plain_punctuation_planted(spark, sf):
    return documents(spark, sf).withColumn("text", ops.plain_punctuation(F.expr(QUOTES_PLANTED)))


CORE = ["control", "tags", "urls", "users", "emails", "ru_phones", "digit_runs", "punctuation", "whitespace"]


@query("clean_text_patterns", PAGES.format(replaced("text", *CORE)))
def clean_text_patterns(spark, sf):
    """Every step of the cleaner that SQL can express."""
    cleaned = ops.clean_text(F.col("text"), entities=False, nfkc=False)
    return pages(spark, sf).withColumn("text", cleaned)


@query("clean_documents_email_first", DOCUMENTS.format(replaced("text", "control", "tags", "urls", "emails", "users", *CORE[5:])))
def clean_documents_email_first(spark, sf):
    cleaned = ops.clean_text(F.col("text"), entities=False, nfkc=False, email_first=True)
    return documents(spark, sf).withColumn("text", cleaned)


@query("clean_text")
def clean_text(spark, sf):
    return pages(spark, sf).withColumn("text", ops.clean_text(F.col("text")))


@query("decode_entities")
def decode_entities(spark, sf):
    return pages(spark, sf).withColumn("text", ops.decode_and_compose(F.col("text")))


@query(
    "missing_text",
    """SELECT page_id, coalesce(regexp_extract(url, '\\?(.*)$', 1), 'nan') AS text
    FROM (SELECT page_id, CASE WHEN contains(url, '?') THEN url END AS url FROM pages)""",
)
def missing_text(spark, sf):
    tail = F.when(F.contains("url", F.lit("?")), F.regexp_extract("url", r"\?(.*)$", 1))
    return table(spark, sf, "pages").select("page_id", ops.missing_as_nan_text(tail).alias("text"))


@query("non_blank_texts", "SELECT conv_id, turn, length(text) AS size FROM conversations WHERE length(trim(text)) > 0")
def non_blank_texts(spark, sf):
    rows = table(spark, sf, "conversations").filter(~ops.is_blank(F.col("text")))
    return rows.select("conv_id", "turn", F.length("text").cast("bigint").alias("size"))


BLANKED = "CASE WHEN turn % 3 = 0 THEN '  ' || {0}(10) || {0}(9) ELSE text END"


@query(
    "non_blank_planted",
    f"""SELECT conv_id, turn, length(text) AS size FROM (SELECT conv_id, turn, {BLANKED.format('chr')} AS text FROM conversations)
    WHERE length(regexp_replace(text, '[ \t\n]', '', 'g')) > 0""",
)
def non_blank_planted(spark, sf):
    """Every third turn is blank."""
    rows = table(spark, sf, "conversations").withColumn("text", F.expr(BLANKED.format("char")))
    kept = rows.filter(~ops.is_blank(F.col("text")))
    return kept.select("conv_id", "turn", F.length("text").cast("bigint").alias("size"))


WORDS = f"regexp_extract_all(lower(text), '{TOKEN}')"
LEXICON = f"""words AS (SELECT DISTINCT unnest({WORDS}) AS token FROM benchmark),
lexicon AS (
  SELECT w.token, CASE WHEN w.token LIKE '%s' AND s.token IS NOT NULL THEN s.token ELSE w.token END AS lemma
  FROM words w LEFT JOIN words s ON s.token = left(w.token, length(w.token) - 1)
  WHERE length(w.token) > 2)"""


def benchmark_lexicon(spark, sf):
    """Words of the benchmark texts; a plural falls to its singular where that is a word too."""
    words = table(spark, sf, "benchmark").select(F.explode(tokens(F.col("text"))).alias("token")).distinct()
    singular = words.select(F.col("token").alias("_singular"))
    stem = F.expr("left(token, length(token) - 1)")
    joined = words.join(singular, stem == F.col("_singular"), "left").filter(F.length("token") > 2)
    lemma = F.when(F.col("token").endswith("s") & F.col("_singular").isNotNull(), F.col("_singular"))
    return joined.select("token", F.coalesce(lemma, F.col("token")).alias("lemma"))


@query(
    "lemmatize_terms",
    f"""WITH {LEXICON},
    placed AS (SELECT doc_id, generate_subscripts({WORDS}, 1) AS pos, unnest({WORDS}) AS token FROM documents)
    SELECT d.doc_id, coalesce(string_agg(lemma, ' ' ORDER BY pos), '') AS lemmas
    FROM documents d LEFT JOIN placed ON placed.doc_id = d.doc_id LEFT JOIN lexicon ON lexicon.token = placed.token
    GROUP BY d.doc_id""",
)
def lemmatize_terms(spark, sf):
    return lemmatize(documents(spark, sf), benchmark_lexicon(spark, sf), key="doc_id").select("doc_id", "lemmas")


RULES = f"""{LEXICON},
changes AS (
  SELECT token, lemma, len(list_filter(range(1, least(length(token), length(lemma)) + 1), lambda i: left(token, i) = left(lemma, i))) AS common
  FROM lexicon),
endings AS (
  SELECT right(token, size) AS suffix, cut, add FROM (
    SELECT token, length(token) - common AS cut, substr(lemma, common + 1) AS add,
      unnest(range(greatest(length(token) - common, 1), least(length(token), length(token) - common + 4) + 1)) AS size FROM changes)),
spoken AS (SELECT suffix, cut, add, count(*) AS n FROM endings GROUP BY 1, 2, 3),
rules AS (
  SELECT suffix, CAST(cut AS INTEGER) AS cut, add, n, total FROM (
    SELECT *, CAST(sum(n) OVER (PARTITION BY suffix) AS BIGINT) AS total,
      row_number() OVER (PARTITION BY suffix ORDER BY n DESC, cut, add) AS place FROM spoken)
  WHERE place = 1 AND n >= 3 AND n >= 0.5 * total)"""


@query("lemma_rules", f"WITH {RULES} SELECT suffix, cut, add, n, total FROM rules")
def lemma_rules(spark, sf):
    return learn_rules(benchmark_lexicon(spark, sf))


@query(
    "lemmatize_all_terms",
    f"""WITH {RULES},
    placed AS (SELECT doc_id, generate_subscripts({WORDS}, 1) AS pos, unnest({WORDS}) AS token FROM documents),
    unseen AS (SELECT DISTINCT token FROM placed WHERE token NOT IN (SELECT token FROM lexicon)),
    guesses AS (
      SELECT token, arg_max(left(token, length(token) - cut) || add, length(suffix)) AS lemma
      FROM (SELECT token, unnest(range(1, length(token) + 1)) AS size FROM unseen) u JOIN rules ON suffix = right(token, size) GROUP BY token),
    every AS (SELECT token, lemma FROM lexicon UNION ALL SELECT token, lemma FROM guesses WHERE lemma <> '')
    SELECT d.doc_id, coalesce(string_agg(lemma, ' ' ORDER BY pos), '') AS lemmas
    FROM documents d LEFT JOIN placed ON placed.doc_id = d.doc_id LEFT JOIN every ON every.token = placed.token
    GROUP BY d.doc_id""",
)
def lemmatize_all_terms(spark, sf):
    """Words outside the benchmark's vocabulary by the rules of their endings."""
    return lemmatize_all(documents(spark, sf), benchmark_lexicon(spark, sf), key="doc_id").select("doc_id", "lemmas")


NAME = "^[A-Z][a-z]{4,}$"


@query(
    "extract_entities",
    f"""WITH names AS (
      SELECT lower(name) AS form, min(name) AS name
      FROM (SELECT unnest(regexp_extract_all(text, '{TOKEN}')) AS name FROM benchmark) WHERE regexp_matches(name, '{NAME}') GROUP BY 1),
    placed AS (SELECT doc_id, generate_subscripts({WORDS}, 1) AS pos, unnest({WORDS}) AS token FROM documents)
    SELECT d.doc_id, coalesce(string_agg(name, '|' ORDER BY pos), '') AS entities
    FROM documents d LEFT JOIN placed ON placed.doc_id = d.doc_id LEFT JOIN names ON names.form = placed.token
    GROUP BY d.doc_id""",
)
def entities(spark, sf):
    words = F.explode(F.regexp_extract_all("text", F.lit(TOKEN), F.lit(0)))
    names = table(spark, sf, "benchmark").select(words.alias("name")).distinct().filter(F.col("name").rlike(NAME))
    found = extract_entities(documents(spark, sf), names, key="doc_id")
    return found.select("doc_id", F.array_join("entities", "|").alias("entities"))


@query(
    "extract_long_names",
    f"""WITH heads AS (SELECT regexp_extract_all(text, '{TOKEN}')[1:5] AS w FROM benchmark),
    names AS (SELECT lower(array_to_string(w, ' ')) AS form, min(array_to_string(w, ' ')) AS name FROM heads WHERE len(w) = 5 GROUP BY 1),
    placed AS (SELECT doc_id, generate_subscripts(w, 1) AS pos, w FROM (SELECT doc_id, {WORDS} AS w FROM documents)),
    found AS (SELECT doc_id, pos, name FROM placed JOIN names ON names.form = array_to_string(w[pos : pos + 4], ' '))
    SELECT d.doc_id, coalesce(string_agg(name, '|' ORDER BY pos), '') AS entities
    FROM documents d LEFT JOIN found ON found.doc_id = d.doc_id GROUP BY d.doc_id""",
)
def long_names(spark, sf):
    """The first five words of every benchmark text are a name."""
    words = F.slice(F.regexp_extract_all("text", F.lit(TOKEN), F.lit(0)), 1, 5)
    heads = table(spark, sf, "benchmark").select(words.alias("w")).filter(F.size("w") == 5)
    found = extract_entities(documents(spark, sf), heads.select(F.array_join("w", " ").alias("name")), key="doc_id")
    return found.select("doc_id", F.array_join("entities", "|").alias("entities"))
