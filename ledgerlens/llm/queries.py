"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

import string

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import blob_ledger, capture_index, combination_join, contamination, fertility, markov_lm, merkle_manifest, token_store, toxic_segments, uniform_shards, viterbi_pieces, whitening, window_packing
from ledgerlens.operators.sizing import written
from ledgerlens.session import work_folder


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def op1_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as compressed token ids in files, read back."""
    tokens = token_store.write_tokens(
        _read(spark, folder, "documents"), work_folder(spark, "tokens"), tokenizer=public_tokenizers.path("word_bpe_49k.json"))
    return token_store.read_tokens(spark, tokens).select(
        F.col("id").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op2_fertility(spark: SparkSession, folder: str) -> DataFrame:
    """Base counts and the fertility verdict of every document."""
    return fertility.judge(_read(spark, folder, "documents"))


def op3_uniform_shuffle(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 24 shards by a uniform shuffle; the law is `rows`."""
    placed = uniform_shards.uniform_shards(_read(spark, folder, "documents"), shards=24)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def _number_of(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def op8_secret_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of every document through a new ledger."""
    found = blob_ledger.scan(_read(spark, folder, "documents"), work_folder(spark, "ledger"))
    kinds = ("assign", "access", "hex")
    base = F.filter("spans", lambda s: s["kind"].isin(*kinds))
    return found.select(
        "doc_id",
        *[_number_of(k).alias(f"n_{k}") for k in kinds],
        F.sha2(blob_ledger.span_text(base).cast("binary"), 256).alias("base_sha256"),
        blob_ledger.span_text(F.col("spans")).alias("spans"))


def op4_toxic_passages(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document by its maximum-scoring segments."""
    scored = toxic_segments.score_texts(_read(spark, folder, "documents"), _read(spark, folder, "labels"))
    return scored.select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("passages").alias("n_passages"))


def op5_capture_index(spark: SparkSession, folder: str) -> DataFrame:
    """Pages as WARC records, all looked up through the capture index and read back."""
    pages = _read(spark, folder, "pages")
    captures = capture_index.write_archives(pages, work_folder(spark, "warc"))
    shards = capture_index.write_index(captures, work_folder(spark, "captures"))
    found = capture_index.read_records(capture_index.lookup(pages, shards))
    return found.select(
        F.col("id").alias("page_id"), F.coalesce(F.octet_length("payload").cast("long"), "payload_bytes").alias("payload_bytes"),
        F.coalesce(F.sha1("payload"), "payload_digest").alias("payload_digest"), F.col("kind").alias("record_type"), "refers_to")


def op6_contamination(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of a document and a benchmark item with 0.8 or more of the item's shingles in the document."""
    return contamination.contained_items(_read(spark, folder, "documents"), _read(spark, folder, "benchmark"))


def op7_sentence_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as sentence pieces and back: pieces, their checksum, and whether the text came back."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    docs = _read(spark, folder, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    back = viterbi_pieces.round_trip(docs, model)
    return back.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"),
        F.char_length("decoded").cast("long").alias("n_chars"), (F.col("decoded") == F.col("text")).alias("exact"))


def op9_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    """Documents by components of links of 80 % or more between their sets of five-word shingles."""
    return combination_join.join_components(_read(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id")


def op10_hidden_markov(spark: SparkSession, folder: str) -> DataFrame:
    """Unigram and hidden Markov log probabilities of every document."""
    return markov_lm.score_texts(_read(spark, folder, "documents"))


def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Proofs of all documents, and what they say of a table in which a third of the texts was lower-cased."""
    columns = ("doc_id", "source", "lang", "n_chars", "text")
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    text = F.when(tampered, lowered).otherwise(F.col("text"))
    claimed = merkle_manifest.digest(*[text if c == "text" else F.col(c) for c in columns])
    proofs = merkle_manifest.prove(_read(spark, folder, "documents"), columns=columns, carry={"claimed": claimed}, mark="")
    found = proofs.withColumn("folded_root", merkle_manifest.folded(F.col("claimed"), F.col("path"), mark=""))
    return found.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", merkle_manifest.siblings_digest(F.col("path")).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_window_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens, written, and their pieces read back."""
    sequences = written(window_packing.pack(
        _read(spark, folder, "documents"), tokenizer=public_tokenizers.path("byte_bpe_50k.json"), end_id=0, window=1024), "sequences")
    return window_packing.read_pieces(sequences).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op13_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Embeddings on their leading 32 principal components, whitened."""
    return whitening.whiten(_read(spark, folder, "embeddings"), most=32, scale=64, shift=1_000_000).withColumnRenamed("id", "vec_id")


QUERIES = {f.__name__: f for f in (op1_token_files, op2_fertility, op3_uniform_shuffle, op4_toxic_passages, op5_capture_index, op6_contamination, op7_sentence_pieces, op8_secret_ledger, op9_ngram_join, op10_hidden_markov, op11_merkle_manifest, op12_window_packing, op13_embedding_whitening)}

#: The distinct shingles of a table: five words, or all words where there are fewer.
_SHINGLES = r"""
    SELECT DISTINCT id, array_to_string(list_slice(w, k, k + 4), ' ') AS shingle
    FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS k
          FROM (SELECT {id} AS id, regexp_extract_all(
                    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
                FROM {table})
          WHERE len(w) > 0)"""

#: H of the named values.
def _digest_sql(*values: str) -> str:
    entries = " || ".join(f"coalesce(strlen({v}::VARCHAR) || ':' || {v}::VARCHAR, '-')" for v in values)
    return f"sha256({entries})"


#: The nodes of the trees over `rows` (part, i, h): part, level, i, h, and n nodes on the level.
_TREE = """
    SELECT part, 0 AS level, i, h, count(*) OVER (PARTITION BY part) AS n FROM {rows}
    UNION ALL
    SELECT part, level + 1, i // 8, sha256(string_agg('64:' || h, '' ORDER BY i)), (n + 7) // 8
    FROM {nodes} WHERE n > 1 GROUP BY part, level, i // 8, n"""

#: The left and the right siblings of each row of `rows` (key, part, i) on every level below the root.
_STEPS = """
    SELECT r.key, t.level, coalesce(string_agg('64:' || t.h, '' ORDER BY t.i) FILTER (WHERE t.i < r.i >> 3 * t.level), '') AS l,
           coalesce(string_agg('64:' || t.h, '' ORDER BY t.i) FILTER (WHERE t.i > r.i >> 3 * t.level), '') AS r
    FROM {rows} r JOIN {nodes} t ON r.part IS NOT DISTINCT FROM t.part AND t.i >> 3 = r.i >> 3 * t.level + 3
    WHERE t.n > 1 GROUP BY r.key, t.level"""

SQL: dict[str, str] = {
    "op11_merkle_manifest": f"""
        WITH RECURSIVE crc AS (
            SELECT doc_id, xor(4294967295::UBIGINT, list_reduce(
                [4294967295::UBIGINT] || [ascii(b)::UBIGINT FOR b IN string_split(doc_id::VARCHAR, '')],
                lambda c, b: list_reduce([xor(c, b)] || [0::UBIGINT FOR k IN range(8)],
                    lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::UBIGINT) ELSE x >> 1 END))) AS crc
            FROM documents),
        docs AS (
            SELECT doc_id AS key, lang AS part, {_digest_sql("doc_id", "source", "lang", "n_chars", "text")} AS h,
                   CASE WHEN crc % 3 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
                        ELSE text END AS tampered,
                   {_digest_sql("doc_id", "source", "lang", "n_chars", "tampered")} AS claimed,
                   row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS i
            FROM documents JOIN crc USING (doc_id)),
        nodes AS ({_TREE.format(rows="docs", nodes="nodes")}),
        subroots AS (SELECT part AS key, 0 AS part, h, row_number() OVER (ORDER BY part NULLS FIRST) - 1 AS i FROM nodes WHERE n = 1),
        tops AS ({_TREE.format(rows="subroots", nodes="tops")}),
        low AS ({_STEPS.format(rows="docs", nodes="nodes")}),
        high AS ({_STEPS.format(rows="subroots", nodes="tops")}),
        steps AS (
            SELECT key, row_number() OVER (PARTITION BY key ORDER BY tree, level) AS k, l, r FROM (
                SELECT key, 0 AS tree, level, l, r FROM low
                UNION ALL
                SELECT d.key, 1, level, l, r FROM docs d JOIN high s ON d.part IS NOT DISTINCT FROM s.key)),
        folds AS (
            SELECT key, 0 AS k, claimed AS h FROM docs
            UNION ALL
            SELECT f.key, f.k + 1, sha256(s.l || '64:' || f.h || s.r) FROM folds f JOIN steps s ON s.key = f.key AND s.k = f.k + 1),
        ends AS (SELECT key, max_by(h, k) AS folded_root FROM folds GROUP BY key),
        proofs AS (SELECT key, sha256(string_agg(l || r, '' ORDER BY k)) AS proof FROM steps GROUP BY key)
        SELECT d.key AS doc_id, d.h AS leaf, s.h AS subroot, t.h AS root, coalesce(proof, sha256('')) AS proof_sha256,
               folded_root, folded_root = t.h AS verified
        FROM docs d JOIN subroots s ON d.part IS NOT DISTINCT FROM s.key JOIN tops t ON t.n = 1
        JOIN ends e ON e.key = d.key LEFT JOIN proofs p ON p.key = d.key""",

    "op6_contamination": f"""
        WITH d AS ({_SHINGLES.format(id="doc_id", table="documents")}),
        i AS ({_SHINGLES.format(id="item_id", table="benchmark")}),
        n AS (SELECT id, count(*) AS n_item FROM i GROUP BY id)
        SELECT d.id AS doc_id, i.id AS item_id, n_item, count(*) AS n_shared
        FROM i JOIN n ON i.id = n.id JOIN d ON d.shingle = i.shingle
        GROUP BY d.id, i.id, n_item HAVING 100 * count(*) >= 80 * n_item""",
    "op9_ngram_join": f"""
        WITH RECURSIVE d AS ({_SHINGLES.format(id="doc_id", table="documents")}),
        n AS (SELECT id, count(*) AS n FROM d GROUP BY id),
        s AS (SELECT x.id AS a, y.id AS b, count(*) AS common
              FROM d x JOIN d y ON x.shingle = y.shingle AND x.id <> y.id GROUP BY x.id, y.id),
        links AS (SELECT s.a, s.b FROM s JOIN n p ON p.id = s.a JOIN n q ON q.id = s.b
                  WHERE 100 * common >= 80 * (p.n + q.n - common)),
        reach AS (SELECT doc_id AS a, doc_id AS b FROM documents
                  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
        SELECT doc_id, coalesce(n.n, 0) AS n_shingles, r.least AS component_id
        FROM documents LEFT JOIN n ON n.id = doc_id
        JOIN (SELECT a, min(b) AS least FROM reach GROUP BY a) r ON r.a = doc_id""",
    "op5_capture_index": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        f AS (SELECT html, max(page_id) AS first FROM p WHERE strlen(html) >= 1000 GROUP BY html),
        j AS (SELECT p.page_id, p.html, CASE WHEN f.first IS DISTINCT FROM p.page_id THEN f.first END AS refers_to
              FROM p LEFT JOIN f USING (html))
        SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS payload_digest,
               CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to
        FROM j""",
}
