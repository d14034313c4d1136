"""Registered queries of the operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import bpe, decontaminate, fertility, merkle, ngram_join, paragraphs, rollups, runs, secrets, simhash, sparse_suffix, training_order, url_lists
from textloom.workspace import fresh_path

Query = Callable[[SparkSession, str], DataFrame]

# Lowest characters per token of ordinary prose; noise of signs, capitals or list rows falls below.
_LEAST = {"de": (1.85, 1.98), "en": (1.75, 1.90), "es": (1.62, 1.84), "fr": (1.70, 1.78)}
_FALLBACK, _ENTROPY, _MOST = 0.1, 5.3, 6.0


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def byte_bpe() -> bpe.Vocabulary:
    return bpe.Vocabulary.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def vocabularies() -> dict:
    """The two vocabularies of the quality rules: one with byte fallback, one of bytes for many languages."""
    return {
        "piece": fertility.piece_model(public_tokenizers.path("piece_bpe_32k.model")),
        "multi": fertility.rank_file(
            public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
        ),
    }


def bands() -> fertility.Bands:
    """Production bands: by language for the four languages, wide ones by script for all others."""
    by_key = {}
    for at, name in enumerate(("piece", "multi")):
        rows = {k: fertility.Band((v[at], _MOST), _FALLBACK, _ENTROPY) for k, v in _LEAST.items()}
        rows["Latin"] = fertility.Band((1.2, _MOST), 0.2, 4.5)
        rows["other"] = fertility.Band((0.25, _MOST), 1.0, 4.0)
        by_key[name] = rows
    return fertility.Bands(by_key)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return bpe.round_trip(docs, byte_bpe()).drop("text")


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table is scanned in two batches: half of the texts, then all of them, of which the ledger knows that half."""
    docs, folder = documents(spark, sf_dir).select("doc_id", "text"), fresh_path(spark, "ledger")
    secrets.scan_batch(docs.filter(F.crc32("text") % 2 == 0), f"{folder}/batch-1", None, key="doc_id")
    secrets.scan_batch(docs, f"{folder}/batch-2", f"{folder}/batch-1", key="doc_id")
    ledger = secrets.read_ledger(spark, f"{folder}/batch-*")
    return secrets.digest(secrets.findings(docs, ledger, key="doc_id"))


def byte_ranks() -> fertility.Ranks:
    return fertility.rank_file(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op3_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = training_order.write_in_training_order(
        documents(spark, sf_dir), fresh_path(spark, "shards"), byte_ranks(), eos=50256
    )
    return out.withColumnRenamed("keys", "doc_ids")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_components(documents(spark, sf_dir))


def op6_sparse_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sparse_suffix.repeated_passages(documents(spark, sf_dir))


def op7_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents come in; one source is withdrawn and one language normalised; one batch comes twice."""
    docs = documents(spark, sf_dir).select(F.col("doc_id").alias("key"), "text", "source", "lang")
    store, name = fresh_path(spark, "rollups"), "byte_bpe_50k"
    whole = rollups.count_tokens(docs, byte_ranks(), name).drop("text").withColumn("deleted", F.lit(False))
    rollups.apply_batch(store, 1, whole)
    withdrawn = docs.filter("source = 'src3'").drop("text")
    withdrawn = withdrawn.withColumns({"n_tokens": F.lit(0), "tokenizer": F.lit(name), "deleted": F.lit(True)})
    rollups.apply_batch(store, 2, withdrawn)
    squeezed = docs.filter("lang = 'fr'").withColumn("text", F.trim(F.regexp_replace("text", r"\s+", " ")))
    revised = rollups.count_tokens(squeezed, byte_ranks(), name).drop("text").withColumn("deleted", F.lit(False))
    rollups.snapshot(spark, store)
    rollups.apply_batch(store, 3, revised)
    rollups.apply_batch(store, 2, withdrawn)
    return rollups.totals(spark, store)


def op8_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    return fertility.quality_rules(docs, vocabularies(), bands()).drop("text")


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with a fetch day that follows from the page number."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return pages.withColumn("fetched", F.expr("date_add(DATE'2024-01-01', cast(page_id * 7 % 366 as int))"))


def list_entries(pages: DataFrame) -> DataFrame:
    """Dated entries for a part of the domains, sections and locations that the pages have."""
    seen = pages.select(url_lists.host_of("url").alias("host"), url_lists.location_of("url").alias("location"))
    seen = seen.filter("host != ''")
    number = F.conv(F.substring(F.md5("pattern"), 1, 6), 16, 10).cast("int")

    def patterns(kind: str, pattern, keep: int) -> DataFrame:
        rows = seen.select(F.lit(kind).alias("kind"), pattern.alias("pattern")).distinct()
        return rows.withColumn("v", number).filter(F.col("v") % keep == 0)

    named = (
        patterns("domain", F.regexp_replace("host", r"^(www|m|blog)\.", ""), 3)
        .unionByName(patterns("prefix", F.substring_index("location", "/", 2), 5))
        .unionByName(patterns("url", F.col("location"), 11))
    )
    category = F.element_at(F.array(*map(F.lit, ("ads", "adult", "spam"))), F.expr("v div 7 % 3 + 1").cast("int"))

    def event(action: str, days: str):
        day = F.expr(f"date_add(DATE'2024-01-01', cast({days} as int))")
        return F.struct(F.lit(action).alias("action"), day.alias("at"))

    events = F.array(
        event("add", "v % 200"), event("remove", "v % 200 + 30 + v % 50"),
        F.when(F.col("v") % 2 == 0, event("add", "v % 200 + 120")),
    )
    rows = named.select("kind", "pattern", category.alias("category"), F.explode(events).alias("e"))
    return rows.filter("e is not null").select("kind", "pattern", "category", "e.action", "e.at")


def op9_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.near_paragraphs(documents(spark, sf_dir))


def op10_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = captures(spark, sf_dir)
    return url_lists.judge(pages, url_lists.intervals(list_entries(pages))).drop("url")


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def with_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, text``; every tenth document's words, by the checksum of its number, go on with a period of their own from some word on."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = r"filter(split(text, '[ \\t\\n\\x0B\\f\\r]+'), x -> x != '')"
    # The words, and what follows from their number, are bound once by a lambda of one element.
    made = f"""transform(transform(array({words}), w -> struct(w, size(w) as n, cast(_g % size(w) as int) as a)),
        s -> array_join(transform(sequence(0, s.n - 1), i -> s.w[if(i < s.a, i,
            s.a + (i - s.a) % cast(1 + (s.n - s.a) div (3 + _g % 8) as int))]), ' '))[0]"""
    repeats = (h % 10 == 0) & F.regexp_like("text", F.lit(r"[^ \t\n\x0B\f\r]"))
    placed = docs.select("doc_id", "text", F.expr("crc32(cast(doc_id as string)) div 10").alias("_g"))
    return placed.select("doc_id", F.when(repeats, F.expr(made)).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(with_repeats(documents(spark, sf_dir)))
    ranked = F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("at"), (-r["period"]).alias("p")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    best = F.array_max(ranked)
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"),
        (-best["at"]).alias("start"), best["length"].alias("length"), (-best["p"]).alias("period"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).withColumn("exponent_milli", F.expr("(1000 * length) div period"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of every document; in a seventh of them, by the checksum of the number, one more character is claimed."""
    docs = documents(spark, sf_dir)
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    longer = F.col("n_chars").cast("decimal(38,0)") + 1
    changed = merkle.field_hash([longer if c == "n_chars" else F.col(c) for c in columns])
    claimed = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, changed)
    return merkle.proofs(merkle.manifest(docs, "doc_id", "lang", columns, claimed)).withColumnRenamed("key", "doc_id")


QUERIES: dict[str, Query] = {
    "op1_bpe": op1_bpe,
    "op2_secrets": op2_secrets,
    "op3_training_order": op3_training_order,
    "op4_decontaminate": op4_decontaminate,
    "op5_ngram_join": op5_ngram_join,
    "op6_sparse_suffix": op6_sparse_suffix,
    "op7_rollups": op7_rollups,
    "op8_fertility": op8_fertility,
    "op9_paragraphs": op9_paragraphs,
    "op10_url_lists": op10_url_lists,
    "op11_simhash": op11_simhash,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_merkle": op13_merkle,
}


def _spans_sql() -> str:
    """Matches of each rule from the pieces between and the matches themselves."""
    rules = [
        ("assign", secrets.ASSIGN, "length(regexp_extract_all(text, '{p}', 2)[i]) >= 12"),
        ("access", "AKIA[A-Z0-9]+", "length(m[i]) >= 18"),
        ("hex", "[0-9a-f]+", "length(m[i]) >= 16"),
        *[(r.kind, r.pattern, "true") for r in secrets.RULES[3:]],
    ]
    parts = []
    for k, (kind, pattern, good) in enumerate(rules):
        p = pattern.replace("'", "''")
        parts.append(f"""
            SELECT doc_id, {k} AS o, '{kind}' AS kind,
                   list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0) AS s,
                   length(m[i]) AS n
            FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM (
                SELECT doc_id, text, regexp_extract_all(text, '{p}') AS m, regexp_split_to_array(text, '{p}') AS g
                FROM d WHERE regexp_matches(text, '{p}')))
            WHERE {good.format(p=p)}""")
    return " UNION ALL ".join(parts)


def _merkle_sql() -> str:
    """Every level of the trees from the one below, then one step up for every row and level."""

    def field(x: str) -> str:
        return f"CASE WHEN {x} IS NULL THEN '-' ELSE strlen({x}::VARCHAR) || ':' || {x}::VARCHAR END"

    def leaf(n_chars: str) -> str:
        return f"sha256({' || '.join(map(field, ('doc_id', 'source', 'lang', n_chars, 'text')))})"

    def tree(name: str, leaves: str) -> str:
        return f"""{name} AS (SELECT g, 0 AS level, i, h, n FROM {leaves} UNION ALL
            SELECT g, level + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), any_value((n + 1) // 2)
            FROM {name} WHERE n > 1 GROUP BY g, level, i // 2)"""

    def way(name: str, rows: str, nodes: str) -> str:
        return f"""{name} AS (SELECT row, g, i, 0 AS level, node, sibs FROM {rows} UNION ALL
            SELECT p.row, p.g, p.i // 2, p.level + 1,
                CASE WHEN s.h IS NULL THEN sha256(p.node) WHEN p.i % 2 = 1 THEN sha256(s.h || p.node) ELSE sha256(p.node || s.h) END,
                p.sibs || coalesce(s.h, '')
            FROM {name} p JOIN {nodes} o ON o.g = p.g AND o.level = p.level AND o.i = p.i AND o.n > 1
            LEFT JOIN {nodes} s ON s.g = p.g AND s.level = p.level AND s.i = xor(p.i, 1))"""

    # The checksum of the number in decimal, bit after bit.
    bits = "flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda x: [ascii(x)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))"
    step = "lambda a, x: xor(xor(a, x) >> 1, 3988292384 * (xor(a, x) & 1))"
    crc = f"xor(list_reduce(list_concat([4294967295::BIGINT], {bits}), {step}), 4294967295)"
    return f"""
        WITH RECURSIVE d AS (SELECT row_number() OVER () AS row, doc_id, coalesce('=' || lang, '') AS g, {leaf("n_chars")} AS leaf,
            CASE WHEN {crc} % 7 = 0 THEN {leaf("(n_chars + 1)")} END AS changed FROM documents),
        l AS (SELECT *, leaf AS h, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
            count(*) OVER (PARTITION BY g) AS n FROM d),
        {tree("t", "l")},
        o AS (SELECT '' AS g, g AS name, h, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n FROM t WHERE n = 1),
        {tree("u", "o")},
        s AS (SELECT row, g, i, coalesce(changed, leaf) AS node, '' AS sibs FROM l),
        {way("p", "s", "t")},
        q AS (SELECT p.row, '' AS g, o.i, p.node, p.sibs FROM p JOIN t ON t.g = p.g AND t.level = p.level AND t.n = 1 JOIN o ON o.name = p.g),
        {way("v", "q", "u")},
        e AS (SELECT v.row, v.node, v.sibs, u.h AS root FROM v JOIN u ON u.level = v.level AND u.n = 1)
        SELECT l.doc_id, l.leaf, o.h AS subroot, e.root, sha256(e.sibs) AS proof_sha256, e.node AS folded_root, e.node = e.root AS verified
        FROM l JOIN e ON e.row = l.row JOIN o ON o.name = l.g"""


ORACLES: dict[str, str] = {
    "op13_merkle": _merkle_sql(),
    "op2_secrets": f"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
        f AS ({_spans_sql()}),
        a AS (SELECT doc_id,
                string_agg(kind || ':' || s::bigint || ':' || (s + n)::bigint, ',' ORDER BY s, o) AS spans,
                string_agg(kind || ':' || s::bigint || ':' || (s + n)::bigint, ',' ORDER BY s, o)
                    FILTER (o < 3) AS base,
                count(*) FILTER (o = 0) AS n_assign, count(*) FILTER (o = 1) AS n_access,
                count(*) FILTER (o = 2) AS n_hex
              FROM f GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
               coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
               coalesce(spans, '') AS spans, sha256(d.text) AS blob
        FROM d LEFT JOIN a USING (doc_id)""",
    "op5_ngram_join": r"""
        WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
              FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS i FROM d)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
              GROUP BY ALL),
        e AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y
              WHERE 100 * c >= 80 * (a.n + b.n - c)),
        r AS (SELECT doc_id AS v, doc_id AS c FROM d UNION SELECT e.y, r.c FROM r JOIN e ON r.v = e.x),
        m AS (SELECT v AS doc_id, min(c) AS component_id FROM r GROUP BY v)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id
        FROM d LEFT JOIN n USING (doc_id) JOIN m USING (doc_id)""",
    "op10_url_lists": r"""
        WITH p AS (SELECT page_id, url, DATE '2024-01-01' + (page_id * 7 % 366)::int AS fetched,
            regexp_extract(lower(url), '^[a-z]+://([^/?#]*)', 1) AS host,
            regexp_replace(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/+$', '') AS path FROM pages),
        n AS (SELECT DISTINCT 'domain' AS kind, regexp_replace(host, '^(www|m|blog)\.', '') AS pattern, 3 AS keep FROM p
            UNION SELECT 'prefix', host || '/' || split_part(path, '/', 2), 5 FROM p WHERE path LIKE '/%'
            UNION SELECT 'prefix', host, 5 FROM p WHERE path NOT LIKE '/%'
            UNION SELECT 'url', host || path, 11 FROM p),
        v AS (SELECT *, ('0x' || substr(md5(pattern), 1, 6))::int AS v FROM n),
        i AS (SELECT kind, pattern, ['ads', 'adult', 'spam'][v // 7 % 3 + 1] AS category,
                DATE '2024-01-01' + (v % 200)::int AS a, DATE '2024-01-01' + (v % 200 + 30 + v % 50)::int AS b,
                CASE WHEN v % 2 = 0 THEN DATE '2024-01-01' + (v % 200 + 120)::int END AS c
              FROM v WHERE v % keep = 0),
        m AS (SELECT page_id, count(*) AS n_entries, string_agg(DISTINCT category, ',' ORDER BY category) AS categories
              FROM p JOIN i ON (kind = 'domain' AND ('.' || host) LIKE ('%.' || pattern)
                    OR kind = 'prefix' AND (host || path || '/') LIKE (pattern || '/%')
                    OR kind = 'url' AND host || path = pattern)
              WHERE (a <= fetched AND fetched < b) OR c <= fetched
              GROUP BY page_id)
        SELECT page_id, fetched, n_entries IS NOT NULL AS blocked, coalesce(n_entries, 0) AS n_entries,
               coalesce(categories, '') AS categories FROM p LEFT JOIN m USING (page_id)""",
}
