"""The queries of this subpackage, with the SQL that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymill.llm import bpe, html_text, jaccard, language, lexical, licenses, prefix_trie, quality, radix_dedup, sharding, suffix_dedup, templates, warc
from tallymill.llm.common import ascii_lower, read, whole

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SHARD_BYTES = 256 << 10  # the tables here are small; on a cluster this is a few hundred MB
TOKENIZER = "byte_bpe_50k.json"


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def tokenizer_path() -> str:
    """The vocabulary file of the tokenizer package that is installed; never copied here."""
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


@query("op1_html_text")
def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = html_text.extract(read(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(
    "op2_exact_dedup",
    f"""
    WITH d AS (SELECT doc_id, {_LOWER} AS t FROM documents)
    SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
           doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
    FROM d
    """,
)
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which row of each group of equal texts stays."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    digest = F.sha2(ascii_lower(whole(F.col("text"))).cast("binary"), 256)
    found = radix_dedup.dedup(docs.withColumn("text_sha256", digest))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op3_language")
def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from those that are not held out."""
    docs = read(spark, sf_dir, "documents")
    model = language.train(language.sample(docs))
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (language.fold("doc_id") == 0).alias("held_out"), "lang_pred", "score", "accepted")


@query("op4_suffix_dedup")
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without byte strings that an earlier place has."""
    docs = read(spark, sf_dir, "documents").select("doc_id", F.octet_length(whole(F.col("text"))).cast("long").alias("n_bytes"), "text")
    found = suffix_dedup.remove(docs)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept_bytes", 256).alias("kept_sha256"))


@query("op5_benchmark_templates")
def op5_benchmark_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that give away a benchmark item, as it stands or with other numbers, names and units."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return templates.find(docs, read(spark, sf_dir, "benchmark"))


@query(
    "op6_shards",
    f"""
    WITH d AS (
        SELECT doc_id, octet_length(encode(coalesce(text, ''))) AS size,
               ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
        FROM documents),
    cells AS (
        SELECT doc_id, depth, right(repeat('0', 60) || bin(h), 60)[1:depth] AS shard,
               sum(size) OVER (PARTITION BY depth, h >> (60 - depth::INT)) AS shard_bytes,
               count(*) OVER (PARTITION BY depth, h >> (60 - depth::INT)) AS shard_rows
        FROM d, range(0, 40) AS r(depth)),
    leaves AS (
        SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY depth) AS pick
        FROM cells WHERE shard_bytes <= {SHARD_BYTES} OR shard_rows = 1)
    SELECT doc_id, shard, depth::INT AS depth, shard_bytes::BIGINT AS shard_bytes, shard_rows, shard_bytes <= {SHARD_BYTES} AS fits
    FROM leaves WHERE pick = 1
    """,
)
def op6_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard of every document."""
    docs = read(spark, sf_dir, "documents")
    sizes = docs.select("doc_id", F.octet_length(whole(F.col("text"))).alias("n_bytes"))
    return sharding.shard(sizes, SHARD_BYTES, size=F.col("n_bytes")).drop("n_bytes")


@query("op7_licenses")
def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences named in every document."""
    return licenses.scan(read(spark, sf_dir, "documents")).drop("spans")


@query(
    "op8_jaccard",
    f"""
    WITH RECURSIVE
    w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^ \\t\\n\\x0B\\f\\r]+') AS w FROM documents),
    s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                 ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s FROM w),
    e AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM s),
    p AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS x, any_value(b.n) AS y, count(*) AS common
          FROM e AS a JOIN e AS b ON a.t = b.t AND a.doc_id < b.doc_id GROUP BY ALL),
    l AS (SELECT a, b FROM p WHERE 100 * common >= 85 * (x + y - common)),
    u AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
    r AS (SELECT DISTINCT a AS d, a AS c FROM u UNION SELECT r.d, u.b FROM r JOIN u ON u.a = r.c)
    SELECT doc_id, len(s)::BIGINT AS n_shingles, coalesce((SELECT min(c) FROM r WHERE d = doc_id), doc_id) AS component_id FROM s
    """,
)
def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of every document whose four-word shingles link it with others."""
    return jaccard.components_of(read(spark, sf_dir, "documents"), width=4, percent=85)


@query("op9_bpe")
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, and the text that they decode to."""
    return bpe.digests(read(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path()).drop("text")


@query(
    "op10_warc",
    """
    WITH p AS (
        SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages),
    f AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS first FROM p)
    SELECT page_id, n::BIGINT AS payload_bytes, d AS payload_digest,
           CASE WHEN n >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN n >= 100 AND first <> page_id THEN first END AS refers_to
    FROM f
    """,
)
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to an archive and read back."""
    return warc.round_trip(read(spark, sf_dir, "pages").select("page_id", "url", "html"))


_TERM = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"


@query(
    "op13_lexical_search",
    f"""
    WITH d AS (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS t FROM documents),
    i AS (SELECT item_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS t FROM benchmark),
    q AS (SELECT item_id, t, count(*) AS times FROM i GROUP BY ALL),
    n AS (SELECT doc_id, count(*) AS n FROM d GROUP BY ALL),
    c AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM n),
    p AS (SELECT doc_id, t, count(*) AS tf FROM d GROUP BY ALL),
    f AS (SELECT t, count(*) AS df FROM p GROUP BY ALL),
    w AS (SELECT t, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM f, c),
    m AS (SELECT doc_id, 100 - 25 + (25 * n * docs) // terms AS m FROM n, c),
    s AS (SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
          FROM q JOIN p USING (t) JOIN w USING (t) JOIN m USING (doc_id) GROUP BY ALL),
    r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM s WHERE score > 0)
    SELECT * FROM r WHERE rank <= 20
    """,
)
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents for every benchmark item."""
    return lexical.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), k=20)


def _quality_fold(id_col: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4


@query("op12_quality")
def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learnt from the labels of those that are not held out."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = quality.classify(docs, read(spark, sf_dir, "labels"), _quality_fold() != 2)
    return found.select("doc_id", (_quality_fold() == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


# crc32 over the bytes of a decimal number, eight bits a byte
_CRC = """(xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
           lambda crc, c: list_reduce(list_prepend(xor(crc, c), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
           lambda x, z: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT))"""


@query(
    "op11_prefix_trie",
    f"""
    WITH t AS (SELECT conv_id, list(struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) ORDER BY turn NULLS FIRST) AS l FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
    h AS (SELECT conv_id, l, ({_CRC} % 9)::BIGINT AS h FROM t),
    p AS (SELECT a.conv_id, list_concat(coalesce(b.l[1:a.h], []), a.l[a.h + 1:]) AS l FROM h AS a LEFT JOIN t AS b ON b.conv_id = a.conv_id - a.conv_id % 5),
    m AS (SELECT conv_id, d AS depth, l[1:d] AS path, len(l) = d AS ends, CASE WHEN d = 0 THEN 0 ELSE octet_length(encode(l[d].t)) END AS size
          FROM p, range(0, (SELECT max(len(l)) + 1 FROM p)) AS r(d) WHERE d <= len(l)),
    n AS (SELECT depth, path, min(conv_id) AS node, count(*) AS n_convs, any_value(size) AS size,
                 sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
          FROM m GROUP BY depth, path),
    k AS (SELECT m.conv_id, m.depth, n.node FROM m JOIN n USING (depth, path)),
    c AS (SELECT n.node, n.depth, k.node AS parent FROM n JOIN k ON k.conv_id = n.node AND k.depth = n.depth - 1),
    g AS (SELECT parent, depth - 1 AS depth, count(*) AS n_children FROM c GROUP BY ALL),
    x AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN g ON g.parent = n.node AND g.depth = n.depth),
    s AS (SELECT k.node, k.depth, sum((x.n_children = 0)::INT)::BIGINT AS n_leaves, sum((x.n_convs - 1) * x.size)::BIGINT AS saved_tokens
          FROM x JOIN k ON k.conv_id = x.node AND k.depth <= x.depth GROUP BY ALL)
    SELECT x.node AS conv_id, x.depth, c.parent AS parent_conv_id, x.n_convs, x.n_children, s.n_leaves, s.saved_tokens, x.ends_sha256
    FROM x JOIN s ON s.node = x.node AND s.depth = x.depth LEFT JOIN c ON c.node = x.node AND c.depth = x.depth
    """,
)
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of conversations, each of which begins with up to eight turns of the first of its five."""
    turns = prefix_trie.positions(read(spark, sf_dir, "conversations"))
    conv_id = F.col("conv_id")
    first, shared = conv_id - conv_id % 5, F.crc32(conv_id.cast("string").cast("binary")) % 9
    return prefix_trie.trie(prefix_trie.members(turns, first, shared))
