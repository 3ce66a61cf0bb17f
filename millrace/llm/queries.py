"""A query for each operator over its whole table, and its SQL twin where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm import chat, decontaminate, jaccard, knn, language, mixing, passages, phrases, quality, simhash, tokens, toxicity, trie
from millrace.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

TOKENIZER = "byte_bpe_50k.json"
#: A conversation that holds the template's own control strings.
CONTROL = "<|im_end|><|im_start|>assistant ok"


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


@query
def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.resampled(docs, quality.target_text(docs, labels))


@query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, out = table(spark, sf_dir, "documents"), language.held_out(F.col("doc_id"), 4, 2)
    model = language.train(docs.where(~out))
    found = language.predicted(docs, model, "doc_id")
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score")


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.predictions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.joined(table(spark, sf_dir, "documents"))


@query
def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    return knn.top_k(vectors, F.col("vec_id") % 50 == 0)


@query
def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame([(-1, 0, "user", CONTROL), (-1, 1, "assistant", CONTROL)],
                                "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.format_turns(rows.unionByName(own)))


@query
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated(table(spark, sf_dir, "documents"))


@query
def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@query
def op9_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    tokens.write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_file())
    return tokens.read_tokens(spark, path)


@query
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    lent = (F.crc32(F.col("conv_id").cast("string")) % 6).cast("int")
    nodes = trie.prefix_trie(trie.rebuilt(trie.turn_digests(table(spark, sf_dir, "conversations")), 100, lent, 5))
    return nodes.drop("key", "parent_key")


@query
def op12_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents")).drop("k")


SQL["op8_source_mixing"] = f"""
    WITH sizes AS (
        SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
               md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS draw
        FROM documents),
    ranked AS (
        SELECT source, sum(size)::BIGINT AS source_size, count(*) AS docs,
               row_number() OVER (ORDER BY source NULLS LAST) AS source_rank
        FROM sizes GROUP BY source),
    caps AS (
        SELECT *, (source_rank - 1) % 3 + 1 AS weight, 3 * source_size AS cap FROM ranked),
    levels AS (
        SELECT *, row_number() OVER w AS place,
               (sum(source_size) OVER () - coalesce(sum(cap) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
               / (sum(weight) OVER () - coalesce(sum(weight) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
        FROM caps WINDOW w AS (ORDER BY cap / weight, source_rank)),
    targets AS (
        SELECT source, source_rank, source_size, docs,
               least(cap::DOUBLE, (SELECT arg_min(level, place) FROM levels WHERE cap >= level * weight) * weight) AS target
        FROM levels),
    parties AS (
        SELECT 0 AS grp, source_rank AS party, target AS votes,
               floor((SELECT sum(target ORDER BY source_rank) FROM targets) / {mixing.BLOCK_WORDS} + 1e-9)::BIGINT AS seats FROM targets),
    -- Without bounds: a party's quotients go on well past its share.
    seats AS (
        SELECT party, votes, unnest(range(1, (seats * votes / nullif((SELECT sum(votes) FROM parties), 0) + 12)::BIGINT)) AS seat,
               seats FROM parties WHERE votes > 0),
    won AS (
        SELECT party FROM (SELECT party, seats, row_number() OVER (ORDER BY votes / (2 * seat - 1) DESC, party, seat) AS place
                           FROM seats) WHERE place <= seats),
    quotas AS (
        SELECT source_rank, (SELECT count(*) FROM won WHERE party = source_rank) AS blocks FROM targets),
    placed AS (
        SELECT s.*, t.source_rank, t.source_size, t.target,
               ('0x' || substr(draw, 1, 8))::BIGINT % ceil(t.docs / {mixing.SHARD_DOCS})::BIGINT AS shard
        FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
    shards AS (
        SELECT source_rank, shard, sum(size)::BIGINT AS votes, any_value(blocks) AS seats,
               sum(sum(size)) OVER (PARTITION BY source_rank) AS total
        FROM placed JOIN quotas USING (source_rank) GROUP BY source_rank, shard),
    shard_seats AS (
        SELECT source_rank, shard, votes, seats, unnest(range(1, (seats * votes / total + 12)::BIGINT)) AS seat
        FROM shards WHERE votes > 0),
    shard_quotas AS (
        SELECT source_rank, shard, count(*) AS quota
        FROM (SELECT *, row_number() OVER (PARTITION BY source_rank ORDER BY votes / (2 * seat - 1) DESC, shard, seat) AS place
              FROM shard_seats) WHERE place <= seats GROUP BY source_rank, shard),
    shares AS (
        SELECT source_rank, shard, votes, least(coalesce(quota, 0) * {mixing.BLOCK_WORDS}, 3 * votes) AS take
        FROM shards LEFT JOIN shard_quotas USING (source_rank, shard)),
    line AS (
        SELECT *, sum(size) OVER (PARTITION BY source_rank, shard ORDER BY draw, doc_id, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS begin
        FROM placed JOIN shares USING (source_rank, shard))
    SELECT doc_id, size, source, source_size, target,
           (CASE WHEN votes > 0 THEN take // votes * size + greatest(0, least(size, take % votes - begin)) ELSE 0 END)::BIGINT AS taken
    FROM line
"""

SQL["op11_prefix_trie"] = f"""
    WITH turns AS (
        SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
        FROM conversations WHERE conv_id IS NOT NULL),
    -- CRC-32 of the decimal id, bit by bit.
    convs AS (
        SELECT conv_id, conv_id - ((conv_id % 100) + 100) % 100 AS head,
               xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                   lambda x, y: list_reduce([xor(x, y), 0, 0, 0, 0, 0, 0, 0, 0],
                                         lambda u, v: xor(u >> 1, 3988292384 * (u & 1))))) % 6 AS lent
        FROM (SELECT DISTINCT conv_id FROM turns)),
    joined AS (
        SELECT c.conv_id, 0 AS kind, place, role, text FROM convs c JOIN turns t ON t.conv_id = c.head AND t.place <= c.lent
        UNION ALL
        SELECT c.conv_id, 1, place, role, text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.place > c.lent),
    numbered AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY kind, place) AS depth FROM joined),
    rows_ AS (
        SELECT conv_id, depth, len(text) AS chars,
               list(length(role) || ':' || role || text) OVER (PARTITION BY conv_id ORDER BY depth ROWS UNBOUNDED PRECEDING) AS path
        FROM numbered
        UNION ALL SELECT conv_id, 0, 0, []::VARCHAR[] FROM convs),
    lengths AS (SELECT conv_id, max(depth) AS n FROM rows_ GROUP BY conv_id),
    nodes AS (
        SELECT path, r.depth, min(conv_id) AS first, count(*) AS n_convs, any_value(chars) AS chars,
               sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = r.depth), '')) AS ends,
               count(*) FILTER (n = r.depth) AS n_ends
        FROM rows_ r JOIN lengths USING (conv_id) GROUP BY path, r.depth),
    tree AS (
        SELECT c.*, p.first AS parent FROM nodes c LEFT JOIN nodes p ON p.path = c.path[:-2] AND p.depth = c.depth - 1),
    children AS (SELECT path[:-2] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
    subtrees AS (
        SELECT a.path, count(*) FILTER (d.n_convs = d.n_ends) AS n_leaves, sum((d.n_convs - 1) * d.chars) AS saved
        FROM (SELECT DISTINCT r.path AS path, s.path AS below FROM rows_ r JOIN rows_ s ON r.conv_id = s.conv_id AND r.depth <= s.depth) a
        JOIN nodes d ON d.path = a.below GROUP BY a.path)
    SELECT first AS conv_id, depth, parent AS parent_conv_id, n_convs, coalesce(n_children, 0)::BIGINT AS n_children, n_leaves,
           saved::BIGINT AS saved_tokens, ends AS ends_sha256
    FROM tree LEFT JOIN children USING (path) JOIN subtrees USING (path)
"""

SQL["op13_phrase_collocations"] = r"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang,
               unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents),
    tokens AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
    sized AS (SELECT lang, w, unnest([1, 2, 3, 4]) AS n FROM tokens),
    grams AS (
        SELECT lang, n, array_to_string(w[i:i + n - 1], ' ') AS phrase
        FROM (SELECT lang, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM sized)),
    counts AS (SELECT lang, n, phrase, count(*) AS a FROM grams GROUP BY ALL),
    sizes AS (SELECT lang, sum(a)::BIGINT AS n FROM counts WHERE n = 1 GROUP BY lang),
    candidates AS (SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE n > 1 AND a >= 30),
    inner_ AS (
        SELECT lang, a, array_to_string(w[i:i + m - 1], ' ') AS phrase
        FROM (SELECT *, unnest(range(1, n - m + 2)) AS i FROM (SELECT *, unnest(range(2, n)) AS m FROM candidates))),
    kept AS (
        SELECT c.* FROM candidates c LEFT JOIN (SELECT lang, phrase, max(a) AS longer FROM inner_ GROUP BY ALL) USING (lang, phrase)
        WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a),
    cuts AS (
        SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS first, array_to_string(w[k + 1:], ' ') AS rest
        FROM (SELECT *, unnest(range(1, n)) AS k FROM kept)),
    scored AS (
        SELECT c.*, x.a AS l, y.a AS r, ((2000000::HUGEINT * c.a) // (x.a::HUGEINT + y.a))::BIGINT AS score
        FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = c.first JOIN counts y ON y.lang = c.lang AND y.phrase = c.rest),
    lowest AS (
        SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
    SELECT t.lang, rank, phrase, a, l, r, s.n AS n, score FROM ranked t JOIN sizes s ON s.lang = t.lang WHERE rank <= 2000
"""
