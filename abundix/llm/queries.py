"""One query per operator over its whole table, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from abundix.llm import bpe, conversations, exact_dedup, jaccard, langid, licenses, mixing, packing, quality, sharding, text_conf, toxicity, urlfilter, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Production parameters.
TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.json"
URL_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
TRACKED = "utm_source="


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def _query(name: str, sql: str | None = None):
    def register(function: Callable[..., DataFrame]):
        QUERIES[name] = lambda spark, folder: function(lambda t: text_conf(spark).read.parquet(f"{folder}/{t}.parquet"))
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


@_query(
    "op1_exact_dedup",
    """
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
        doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
    FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
    WINDOW same AS (PARTITION BY t)
    """,
)
def exact_dedup_query(table):
    return exact_dedup.exact_groups(table("documents"))


@_query(
    "op2_ngram_jaccard",
    r"""
    WITH RECURSIVE words AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x20\x09-\x0D]+') AS w
        FROM documents),
    shingles AS (
        SELECT DISTINCT doc_id, s FROM (
            SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
            FROM words)),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
    common AS (
        SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
        FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
    links AS (
        SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= 90 * (p.n + q.n - c)),
    reach AS (
        SELECT a AS doc_id, a AS other FROM links
        UNION
        SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other)
    SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(c, d.doc_id) AS component_id
    FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN (SELECT doc_id, min(other) AS c FROM reach GROUP BY 1) USING (doc_id)
    """,
)
def ngram_jaccard(table):
    return jaccard.jaccard_components(table("documents"), width=3, num=90, den=100)


def _quality_sql() -> str:
    """Cutoffs with the whole risk spent on the rules together, tested set by set."""
    steps = quality.joint_steps(quality.LADDERS)
    risk, last = quality.RISK, len(steps)
    grown = [" OR ".join(f"{rule} > {cut}" for rule, cut in steps[: i + 1]) for i in range(last)]
    counts = ", ".join(f"count(*) FILTER (held AND ({fails})) AS k{i}" for i, fails in enumerate(grown))
    totals = ", ".join(f"sum({c})::BIGINT AS {c}" for c in ("n", *(f"k{i}" for i in range(last))))

    def tail(k: str) -> str:
        return (
            f"list_sum(list_transform(range(0, {k} + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)"
            f" + i * ln({risk!r}) + (n - i) * ln(1 - {risk!r}))))"
        )

    def passed(safe: str) -> str:
        """How many sets are safe before the first that is not."""
        return f"CASE {' '.join(f'WHEN NOT ({safe.format(k=f"k{i}", tail=tail(f"k{i}"))}) THEN {i}' for i in range(last))} ELSE {last} END"

    proven = passed(f"n > 0 AND {{k}} <= n * {risk!r} AND {{tail}} <= error")
    lent = passed(f"{{k}} <= n * {risk!r}")
    stricter = {rule: [(i, cut) for i, (name, cut) in reversed(list(enumerate(steps))) if name == rule] for rule in quality.LADDERS}
    cuts = ", ".join(f"CASE {' '.join(f'WHEN passed > {i} THEN {cut}' for i, cut in of)} END AS max_{rule}" for rule, of in stricter.items())
    hits = ", ".join(f"CASE WHEN {rule} > max_{rule} THEN '{rule}' END" for rule in quality.LADDERS)
    return rf"""
    WITH words AS (
        SELECT doc_id, lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    windows AS (
        SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM words)),
    again AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, s) AS c FROM windows) WHERE c > 1),
    covered AS (SELECT doc_id, count(DISTINCT i + o) AS n_repeat_words FROM again, range(3) AS r(o) GROUP BY 1),
    lines AS (
        SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
        FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM words)
        WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY 1),
    counts AS (
        SELECT doc_id, lang, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
            length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, length(regexp_replace(t, '\P{{Lu}}+', '', 'g')) AS n_capitals,
            length(t) - length(replace(t, '!', '')) AS n_exclaims, coalesce(n_dup_lines, 0) AS n_dup_lines,
            coalesce(n_repeat_words, 0) AS n_repeat_words
        FROM words LEFT JOIN covered USING (doc_id) LEFT JOIN lines USING (doc_id)),
    features AS (
        SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
            CASE WHEN word_chars = 0 THEN 0 ELSE n_symbols * 10000 // word_chars END AS symbols,
            CASE WHEN word_chars = 0 THEN 0 ELSE n_capitals * 10000 // word_chars END AS capitals,
            CASE WHEN word_chars = 0 THEN 0 ELSE n_exclaims * 10000 // word_chars END AS exclaims,
            CASE WHEN n_words = 0 THEN 0 ELSE word_chars * 100 // n_words END AS word_length,
            CASE WHEN n_words = 0 THEN 0 ELSE n_repeat_words * 10000 // n_words END AS repeats
        FROM counts),
    good AS (SELECT doc_id FROM labels WHERE quality IS NOT NULL GROUP BY 1 HAVING min(quality) = 1),
    marked AS (SELECT f.*, g.doc_id IS NOT NULL AND NOT base_failed AS held FROM features f LEFT JOIN good g ON g.doc_id = f.doc_id),
    tried AS (SELECT lang, count(*) FILTER (held) AS n, {counts} FROM marked GROUP BY 1),
    level AS (SELECT 0.05 / (count(*) FILTER (n > 0) + 1) AS error FROM tried),
    pool AS (SELECT {proven} AS pool FROM (SELECT {totals} FROM tried), level),
    chosen AS (
        SELECT lang, CASE WHEN n * ln(1 - {risk!r}) > ln(error) THEN least(pool, {lent}) ELSE {proven} END AS passed
        FROM tried, level, pool),
    cutoffs AS (SELECT lang, {cuts} FROM chosen),
    judged AS (
        SELECT f.*, list_filter([{hits}], lambda x: x IS NOT NULL) AS r
        FROM features f LEFT JOIN cutoffs c ON f.lang IS NOT DISTINCT FROM c.lang)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        NOT base_failed AND len(r) = 0 AS kept, coalesce(array_to_string(r, ','), '') AS rejected_by
    FROM judged
    """


@_query("op3_quality_rules", _quality_sql())
def quality_rules(table):
    return quality.quality_verdicts(table("documents"), table("labels"), choose=quality.joint_thresholds)


@_query("op4_toxicity")
def toxicity_query(table):
    docs = table("documents").select("doc_id", "text")
    may_learn = toxicity.learnable(F.col("doc_id"), 3, 1)
    score = toxicity.scorer(docs.sparkSession, toxicity.fit(docs, table("labels").where(may_learn).select("doc_id", "toxic")))
    out = docs.select("doc_id", score(F.col("text")).alias("s"))
    return out.select(
        "doc_id",
        (~may_learn).alias("held_out"),
        F.col("s.score").alias("score"),
        (F.col("s.score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        "s.n_offending",
        "s.worst_start",
        "s.worst_length",
    )


def _canonical_sql(text: str) -> str:
    out = f"regexp_replace(lower(coalesce({text}, '')), '(^|\\n)[ \\t*#/;]*(copyright[^\\n]*([0-9]{{4}}|\\(c\\)|©)|\\(c\\)|©)[^\\n]*', chr(10), 'g')"
    out = f"' ' || regexp_replace({out}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g') || ' '"
    for old, new in licenses.SPELLINGS:
        out = f"replace({out}, '{old}', '{new}')"
    return f"trim({out})"


def _license_sql() -> str:
    known = ", ".join(f"('{k}', '{t}')" for k, texts in licenses.KNOWN.items() for t in texts)
    return f"""
    WITH known AS (
        SELECT sha256({_canonical_sql('t')}) AS digest, min(license) AS license FROM (VALUES {known}) AS v(license, t) GROUP BY 1),
    lines AS (
        SELECT doc_id, sha256({_canonical_sql('line')}) AS digest
        FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents)),
    said AS (SELECT doc_id, string_agg(DISTINCT license, ',' ORDER BY license) AS statements FROM lines JOIN known USING (digest) GROUP BY 1)
    SELECT doc_id, text_digest, license, coalesce(statements, '') AS statements
    FROM (SELECT doc_id, sha256({_canonical_sql('text')}) AS text_digest FROM documents) d
    LEFT JOIN known ON known.digest = d.text_digest LEFT JOIN said USING (doc_id)
    """


@_query("op5_license_scan", _license_sql())
def license_scan(table):
    return licenses.scan_licenses(table("documents"))


@_query("op6_packing")
def packing_query(table):
    return packing.pack_documents(table("documents"), tokenizer_path())


@_query("op7_source_mix")
def source_mix(table):
    return mixing.mix(table("documents"), F.array("source")).select("doc_id", "size", "source_size", "target", "taken")


@_query("op8_language_id")
def language_id(table):
    docs = table("documents")
    may_learn = toxicity.learnable(F.col("doc_id"), 4, 2)
    predict = langid.predictor(docs.sparkSession, langid.fit(docs.where(may_learn)))
    out = docs.select("doc_id", (~may_learn).alias("held_out"), predict(F.col("text")).alias("p"))
    return out.select("doc_id", "held_out", "p.lang_pred", "p.score")


def _url_sql() -> str:
    order = sorted(URL_RULES, key=lambda r: -len(r[1] + r[2]))
    fits = [f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')" for _, h, p in order]
    rule = " ".join(f"WHEN {f} THEN '{h + p}'" for f, (_, h, p) in zip(fits, order))
    verdict = " ".join(f"WHEN {f} THEN '{v}'" for f, (v, _, _) in zip(fits, order))
    return rf"""
    WITH parts AS (
        SELECT page_id, url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
    seen AS (
        SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
        FROM parts),
    tracked AS (SELECT DISTINCT host || path AS key FROM seen WHERE contains(url, '{TRACKED}')),
    judged AS (SELECT page_id, host, path, key IS NOT NULL AS listed FROM seen LEFT JOIN tracked ON key = host || path)
    SELECT page_id, host, path, CASE {rule} END AS rule,
        CASE {verdict} WHEN listed THEN 'block' ELSE 'allow' END AS verdict, listed
    FROM judged
    """


@_query("op9_url_filter", _url_sql())
def url_filter(table):
    """The listed keys are those of the pages that are linked with a campaign parameter."""
    return urlfilter.judge_urls(table("pages"), URL_RULES, F.contains(F.col("url"), F.lit(TRACKED)))


def _shard_sql() -> str:
    names, slots = sharding.SHARDS, sharding.SLOTS
    h = "('0x' || substr(md5({}), 1, 15))::BIGINT"
    values = ", ".join(f"({i}, '{name}')" for i, name in enumerate(names))
    return f"""
    WITH RECURSIVE shards AS (
        SELECT list(start_at ORDER BY i) AS starts, list(stride ORDER BY i) AS strides
        FROM (SELECT i, {h.format("name || '#start'")} % {slots} AS start_at, {h.format("name || '#stride'")} % {slots - 1} + 1 AS stride
            FROM (VALUES {values}) AS v(i, name))),
    turns AS (
        SELECT 0 AS turn, list_transform(range({slots}), lambda x: -1::BIGINT) AS held FROM shards
        UNION ALL
        SELECT turn + 1, list_transform(held, lambda x, p: CASE WHEN p - 1 = spot THEN turn % {len(names)} ELSE x END)
        FROM (
            SELECT turn, held, list_filter(walk, lambda s: held[s + 1] = -1)[1] AS spot
            FROM (SELECT turn, held, list_transform(range({slots}),
                    lambda j: (starts[turn % {len(names)} + 1] + j * strides[turn % {len(names)} + 1]) % {slots}) AS walk
                FROM turns, shards WHERE turn < {slots}))),
    filled AS (SELECT held FROM turns WHERE turn = {slots}),
    placed AS (SELECT doc_id, {h.format("coalesce(doc_id::VARCHAR, '')")} % {slots} AS slot FROM documents)
    SELECT doc_id, slot, held[slot + 1]::INTEGER AS shard FROM placed, filled
    """


@_query("op10_sharding", _shard_sql())
def sharding_query(table):
    return sharding.place(table("documents").select("doc_id"))


@_query("op11_conversation_repair")
def conversation_repair(table):
    return conversations.summarise(conversations.repair(conversations.damage(table("conversations"))))


@_query("op12_embedding_whitening")
def embedding_whitening(table):
    embeddings = table("embeddings")
    return whitening.whiten(embeddings, whitening.fit(embeddings))


@_query("op13_bpe_codec")
def bpe_codec(table):
    path = tokenizer_path(BYTE_TOKENIZER)
    encoded = bpe.encode_documents(table("documents"), path)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(bpe.decoder(path)(F.col("ids")), 256).alias("decoded_sha256"),
    )
