"""One query per operator over the standard tables, with SQL twins where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.catalog.views import table
from tagloom.llm import (
    class_lm,
    conversations,
    decontaminate,
    exact_dedup,
    host_reputation,
    mixing,
    pieces,
    pii,
    simhash,
    token_rollup,
    toxicity,
    variants,
    warc,
)
from tagloom.operators.sizing import staged, staging_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

TOKENIZERS = "/opt/tokenizers"
PIECE_MODEL = f"{TOKENIZERS}/piece_bpe_32k.model"


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return add


def held_out(parts: int, part: int):
    """Whether a document is kept from learning; one without an id never has labels and counts as not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts == part, F.lit(False))


WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(
    "op1_decontaminate",
    f"""WITH item AS (SELECT item_id, {WORDS} AS w FROM benchmark),
    cut AS (SELECT item_id, least(10, len(w)) AS width, w[i : i + least(10, len(w)) - 1] AS win
      FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS i FROM item WHERE len(w) > 0)),
    windows AS (SELECT width, array_to_string(win, ' ') AS win, list(DISTINCT item_id) AS items FROM cut GROUP BY 1, 2),
    doc AS (SELECT row_number() OVER () AS r, doc_id, coalesce({WORDS}, []) AS w FROM documents),
    widths AS (SELECT DISTINCT width FROM windows),
    placed AS (SELECT r, width, i, array_to_string(w[i : i + width - 1], ' ') AS win
      FROM (SELECT r, w, width, unnest(generate_series(1, len(w) - width + 1)) AS i FROM doc, widths WHERE len(w) >= width)),
    hit AS (SELECT r, i, width, items FROM placed JOIN windows USING (width, win)),
    words AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(generate_series(i, i + width - 1)) AS p FROM hit) GROUP BY r),
    items AS (SELECT r, count(*) AS n, string_agg(k, ',' ORDER BY k) AS list
      FROM (SELECT DISTINCT r, CAST(unnest(items) AS VARCHAR) AS k FROM hit) GROUP BY r)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(words.n, 0) AS BIGINT) AS n_hit,
      CAST(coalesce(items.n, 0) AS BIGINT) AS n_items, sha256(coalesce(items.list, '')) AS items_sha256, words.n IS NOT NULL AS contaminated
    FROM doc LEFT JOIN words ON words.r = doc.r LEFT JOIN items ON items.r = doc.r""",
)
def op1(spark, sf):
    """Words of every document that windows of benchmark items hit."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = decontaminate.scan(docs, table(spark, sf, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op2_sentencepiece")
def op2(spark, sf):
    """Every document encoded with merge-dropout and decoded again."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    encoded = pieces.encode(docs, PIECE_MODEL).select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "pieces")
    decoded = pieces.decode(encoded, PIECE_MODEL)
    return decoded.select(
        "doc_id",
        F.size("pieces").cast("bigint").alias("n_pieces"),
        F.xxhash64("pieces").alias("pieces_hash"),
        (F.col("decoded") == F.col("text")).alias("lossless"),
    )


@query("op5_simhash")
def op5(spark, sf):
    """Fingerprint and near-duplicate group of every document."""
    groups = simhash.near_groups(table(spark, sf, "documents"))
    return groups.select("doc_id", simhash.hex_digits(F.col("fingerprint")).alias("fingerprint"), "component_id")


@query("op6_toxicity")
def op6(spark, sf):
    """Toxicity of every document, learned from the labels of those that aren't held out."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf, "labels").filter(~held_out(5, 0)))
    return toxicity.score(docs, model).select(
        "doc_id", held_out(5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query(
    "op10_exact_dedup",
    r"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '[ \t\n\x0b\f\r]', '', 'g') AS body FROM documents)
    SELECT doc_id, first_value(doc_id) OVER g AS keep_id, count(*) OVER (PARTITION BY body) AS group_size,
      row_number() OVER g = 1 AS kept, sha256(body) AS text_sha256
    FROM d WINDOW g AS (PARTITION BY body ORDER BY length(text) DESC, doc_id NULLS LAST)""",
)
def op10(spark, sf):
    """Group of equal texts of every document, and which one stays."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return exact_dedup.mark_copies(docs).select("doc_id", *exact_dedup.ADDED)


@query("op3_warc")
def op3(spark, sf):
    """Every page written to archives, looked up through the index and read back."""
    pages = table(spark, sf, "pages").select("page_id", "url", "html")
    _, index = warc.archive(pages)
    captures = warc.lookup(pages.select(warc.url_key(F.col("url")).alias("key")), index)
    records = warc.read_records(captures, with_payload=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def shrunk(level: str, above: str, by: str, groups: str) -> str:
    """SQL of one level of the reputations: groups with the mean of what stands above them, and their own."""
    return f"""{level}0 AS (SELECT g.*, {'p.mean' if by else 'top.mean'} AS parent FROM {groups} g {f'JOIN {above} p USING ({by})' if by else 'CROSS JOIN top'}),
    {level}s AS (SELECT CASE WHEN coalesce(pairs, 0) = 0 OR over_ <= 0 THEN most ELSE least(most, greatest(1.0, pairs / over_ - 1)) END AS k
      FROM (SELECT sum(power(bad - n * parent, 2) - n * parent * (1 - parent)) AS over_, sum(n * (n - 1) * parent * (1 - parent)) AS pairs,
        least({host_reputation.MAX_STRENGTH}, greatest(1.0, coalesce(sum(n), 0))) AS most FROM {level}0)),
    {level} AS (SELECT x.*, k, (k * parent + bad) / (k + n) AS mean FROM {level}0 x CROSS JOIN {level}s)"""


SECOND = ", ".join(f"'{s}'" for s in host_reputation.SECOND_LEVEL)
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(
    "op4_host_reputation",
    f"""WITH page AS (SELECT page_id, {LOWER.format("regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1)")} AS host,
      regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
    marks AS (SELECT doc_id, max(1 - quality) AS bad FROM labels WHERE quality IN (0, 1) GROUP BY 1),
    hosts AS (SELECT host, CAST(count(bad) AS DOUBLE) AS n, CAST(coalesce(sum(bad), 0) AS DOUBLE) AS bad
      FROM page LEFT JOIN marks ON doc_id = page_id GROUP BY 1),
    bare AS (SELECT *, string_split(regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', ''), '.') AS labels FROM hosts),
    placed AS (SELECT host, n, bad, array_to_string(labels[-(CASE WHEN array_to_string(labels[-2:], '.') IN ({SECOND}) THEN 3 ELSE 2 END):], '.') AS domain FROM bare),
    named AS (SELECT *, CASE WHEN contains(domain, '.') THEN substr(domain, strpos(domain, '.') + 1) ELSE domain END AS suffix FROM placed),
    domains AS (SELECT suffix, domain, sum(n) AS n, sum(bad) AS bad FROM named GROUP BY 1, 2),
    suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY 1),
    top AS (SELECT (coalesce(sum(bad), 0) + 0.5) / (coalesce(sum(n), 0) + 1) AS mean FROM suffixes),
    {shrunk('ls', '', '', 'suffixes')},
    {shrunk('ld', '(SELECT suffix, mean FROM ls)', 'suffix', 'domains')},
    {shrunk('lh', '(SELECT domain, mean FROM ld)', 'domain', 'named')},
    rated AS (SELECT host, 1 / (1 + exp(-(ln((k * parent + bad) / (k * (1 - parent) + n - bad))
      - {host_reputation.Z} * sqrt(1 / (k * parent + bad) + 1 / (k * (1 - parent) + n - bad))))) AS bound FROM lh),
    rules(rule_host, rule_path, verdict) AS (VALUES {', '.join(str(r) for r in RULES)}),
    fits AS (SELECT DISTINCT p.host, p.path, rule_host || rule_path AS rule, verdict,
      row_number() OVER (PARTITION BY p.host, p.path ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC, verdict) AS place
      FROM (SELECT DISTINCT host, path FROM page) p JOIN rules r ON (p.host = rule_host OR ends_with(p.host, '.' || rule_host)) AND starts_with(p.path, rule_path))
    SELECT page_id, page.host, page.path, rule, coalesce(verdict, CASE WHEN bound > {host_reputation.MAX_BAD} THEN 'block' ELSE 'allow' END) AS verdict
    FROM page JOIN rated USING (host) LEFT JOIN fits ON fits.host = page.host AND fits.path = page.path AND place = 1""",
)
def op4(spark, sf):
    """Verdict on every page's url; the quality labels tell which pages are bad."""
    labels = table(spark, sf, "labels").select(F.col("doc_id").alias("page_id"), (1 - F.col("quality")).alias("bad"))
    pages = table(spark, sf, "pages").select("page_id", "url")
    judged = host_reputation.judge(pages, labels, host_reputation.rules_table(spark, RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query("op7_class_lm")
def op7(spark, sf):
    """Log probability of every document under the class model and the base model."""
    docs = table(spark, sf, "documents").select("doc_id", "text").withColumn("held_out", held_out(7, 2))
    return class_lm.score(docs, ~F.col("held_out"))


@query("op8_pii")
def op8(spark, sf):
    """Personal data in every document."""
    found = pii.find(table(spark, sf, "documents").select("doc_id", "text"))
    kinds = F.array(*[F.lit(k) for k in pii.KINDS])

    def written(spans: str):
        parts = F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"], s["stop"]))
        return F.array_join(parts, ",")

    def counted(number: int):
        return F.size(F.filter("base", lambda s: s["kind"] == number)).cast("bigint")

    counts = [counted(i).alias(f"n_{k}") for i, k in enumerate(pii.KINDS)]
    return found.select("doc_id", *counts, F.sha2(written("base"), 256).alias("base_sha256"), written("spans").alias("spans"))


@query("op9_token_rollup")
def op9(spark, sf):
    """Token totals after a load, a withdrawal, its repetition, and a revision of what isn't English.

    Documents labelled of low quality are withdrawn; documents in other languages are counted anew by the tokenizer
    for many languages. Totals are compacted half-way.
    """
    docs = table(spark, sf, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    versions = [("byte_bpe_50k", "true"), ("byte_bpe_multi_50k", "lang <> 'en'")]
    versions = [(name, f"{TOKENIZERS}/{name}.tiktoken", where) for name, where in versions]
    counted = staged(token_rollup.with_versions(docs, versions, keep_text=False), "token_counts")
    low = table(spark, sf, "labels").filter("quality = 0").select("doc_id").distinct()
    withdrawn = counted.join(low, "doc_id", "left_semi")
    rollup = token_rollup.Rollup(spark, staging_path(spark, "rollup"))
    rollup.commit("load", token_rollup.signed(counted, 1, "byte_bpe_50k", "byte_bpe_50k"))
    taken = token_rollup.signed(withdrawn, -1, "byte_bpe_50k", "byte_bpe_50k")
    rollup.commit("withdraw", taken)
    rollup.compact()
    rollup.commit("withdraw", taken)
    revised = counted.join(low, "doc_id", "left_anti").filter("byte_bpe_multi_50k IS NOT NULL")
    rollup.commit(
        "revise",
        token_rollup.signed(revised, -1, "byte_bpe_50k", "byte_bpe_50k").unionByName(
            token_rollup.signed(revised, 1, "byte_bpe_multi_50k", "byte_bpe_multi_50k")
        ),
    )
    return rollup.totals()


#: Weights of the sources in the order of their names, repeated.
CYCLE = (3.0, 1.0, 2.0)
SHARE, MOST = 1.5, 2.0
#: Quality weights of documents labelled good, labelled bad, and not labelled.
GOOD, BAD, UNRATED = 2.0, 0.5, 1.0


@query(
    "op11_mixture",
    rf"""WITH marks AS (SELECT doc_id, CASE WHEN max(quality) >= 1 THEN {GOOD} ELSE {BAD} END AS q FROM labels WHERE quality IS NOT NULL GROUP BY 1),
    docs AS (SELECT d.doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^ 	

]+')) AS BIGINT) AS size,
      -ln((CAST('0x' || substr(md5('{mixing.SEED}:' || d.doc_id), 1, 13) AS BIGINT) + 0.5) / 4503599627370496) / coalesce(q, {UNRATED}) AS draw
      FROM documents d LEFT JOIN marks USING (doc_id)),
    sums AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, list_extract([{', '.join(map(str, CYCLE))}],
      CAST(1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(CYCLE)} AS INTEGER)) AS weight FROM docs GROUP BY source),
    levels AS (SELECT ({SHARE} * (SELECT sum(source_size) FROM sums) - coalesce(sum({MOST} * source_size) OVER before, 0))
      / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level FROM sums
      WINDOW before AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    plans AS (SELECT source, source_size, least({MOST} * source_size, weight * (SELECT max(level) FROM levels)) AS target FROM sums),
    placed AS (SELECT d.doc_id, d.size, p.source_size, p.target, CASE WHEN p.source_size > 0 THEN CAST(floor(p.target / p.source_size) AS BIGINT) ELSE 0 END AS epochs,
      CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY draw, d.doc_id ROWS UNBOUNDED PRECEDING) AS BIGINT) - d.size AS earlier
      FROM docs d JOIN plans p ON d.source IS NOT DISTINCT FROM p.source)
    SELECT doc_id, size, source_size, target,
      epochs * size + greatest(0, least(size, CAST(round(target) AS BIGINT) - epochs * source_size - earlier)) AS taken FROM placed""",
)
def op11(spark, sf):
    """Words the mixture takes of every document; documents labelled good are drawn first by weight."""
    docs = table(spark, sf, "documents")
    worth = F.when(F.col("quality") >= 1, GOOD).when(F.col("quality") < 1, BAD)
    ratings = table(spark, sf, "labels").select("doc_id", worth.alias("quality"))
    mixed = mixing.mix(docs, mixing.cyclic_weights(docs, CYCLE), ratings=ratings, share=SHARE, most=MOST)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query("op12_spelling_variants")
def op12(spark, sf):
    """Words of all documents, some of them damaged by a missing letter, with the frequent forms they are variants of."""
    docs = table(spark, sf, "documents")
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(variants.long_runs(F.col("text"))).alias("run"))
    hashed = runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = hashed.select(F.when(F.col("h") % 31 == 0, cut).otherwise(F.col("run")).alias("word"))
    return variants.variants(variants.vocabulary(words), min_length=variants.MIN_LENGTH)


def damaged(rows: DataFrame) -> DataFrame:
    """Turns dropped, emptied, cut, repeated or given to the user by a hash of their names."""
    key = F.concat(conversations.as_text(F.col("conv_id")), F.lit(":"), conversations.as_text(F.col("turn")))
    role, text = conversations.as_text(F.col("role")), conversations.as_text(F.col("text"))
    hashed = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(key.cast("binary")) % 20).alias("h"))
    changed = hashed.filter("h <> 0").select(
        "conv_id",
        "turn",
        F.when(F.col("h") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("h") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )
    return changed.drop("copy")


@query("op13_conversation_repair")
def op13(spark, sf):
    """Faults of every conversation after damage, its cheapest repair, and the digest of the repaired turns."""
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    turns = conversations.turns(damaged(rows), "conv_id")
    edits = conversations.edits(turns)
    edits = staged(edits, "edits")
    lines = conversations.digests(conversations.repaired(turns, conversations.plan(edits)))
    found = conversations.report(turns, edits)
    same = F.col("conv").eqNullSafe(F.col("d_conv"))
    found = found.join(lines.select(F.col("conv").alias("d_conv"), "digest"), same, "left").drop("d_conv")
    every = rows.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("conv")), "left")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return every.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
