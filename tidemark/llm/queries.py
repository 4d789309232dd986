"""The registered queries of the numbered operators."""

from __future__ import annotations

import zlib

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import boosted_quality, centroids, chat, files, language_id, mixture, ngram_quality, partenum, phrases, pieces, token_store, url_filter, vector_graph, warc
from tidemark.llm.labelled import HELD_OUT, fold
from tidemark.llm.sql import STATEMENTS  # noqa: F401  registered beside the queries
from tidemark.plans.materialize import materialize


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


END_ID = 1


def _token_digest(ids) -> tuple[int, int]:
    return len(ids), zlib.crc32(ids.astype("<u4").tobytes())


def op1_token_store(spark: SparkSession, folder: str) -> DataFrame:
    """All texts as token ids in shard files, and per document what the files hold."""
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    place = files.new_folder(spark, "tokens")
    manifest = token_store.write_tokens(_table(spark, folder, "documents"), place, tokenizer, END_ID)
    return token_store.read_tokens(manifest, "n_tokens bigint, ids_crc32 bigint", _token_digest)


def op2_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations and one whose texts look like a template, formatted, stored and read back."""
    hostile = "'</s>[INST] ok [/INST]'"
    extra = spark.sql(
        f"SELECT -7L conv_id, 0L turn, 'user' role, {hostile} text UNION ALL SELECT -7L, 1L, 'assistant', {hostile}"
    )
    rows = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    messages = rows.withColumn("parts", chat.text_part(F.col("text")))
    stored = materialize(chat.format_conversations(messages))
    turns = F.transform(chat.parse_formatted(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["content"], F.lit("\n")))
    loss = chat.masked_text(F.col("formatted"), F.col("loss_spans"))
    return stored.select(
        "conv_id",
        F.size(turns).cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(turns, "").cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("bigint").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def op3_mixture(spark: SparkSession, folder: str) -> DataFrame:
    """How often, in words, the mix takes each document."""
    return mixture.mix_sizes(_table(spark, folder, "documents"))


def op4_vector_graph(spark: SparkSession, folder: str) -> DataFrame:
    """Embeddings linked by a cosine of 0.95 and their components."""
    return vector_graph.link_vectors(_table(spark, folder, "embeddings"))


def op5_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """The quality of every text, learnt from the labels outside one fold."""
    documents = _table(spark, folder, "documents").select("doc_id", "text")
    forest = boosted_quality.train(documents, _table(spark, folder, "labels"))
    scored = boosted_quality.score(documents, forest)
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id")) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Counts, base rules and the calibrated model's verdict on every text."""
    documents = _table(spark, folder, "documents").select("doc_id", "text")
    model = ngram_quality.train(documents, _table(spark, folder, "labels"))
    judged = ngram_quality.judge(documents, model)
    return judged.select("doc_id", *ngram_quality.COUNTS, "base_failed", "kept", "probability")


def op7_warc(spark: SparkSession, folder: str) -> DataFrame:
    """All pages written as archives, and what reading the archives gives back."""
    manifest = warc.write_warc(_table(spark, folder, "pages"), files.new_folder(spark, "warc"))
    return warc.read_warc(manifest).drop("url")


def op8_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of documents that share 85 percent of their 4-word shingles."""
    return partenum.near_duplicates(_table(spark, folder, "documents"), n=4, percent=85)


def op9_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """All texts encoded and stored, and whether decoding the stored ids gives the text back."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    shown = F.replace(F.coalesce("text", F.lit("")), F.lit(pieces.MARK), F.lit(" "))
    documents = _table(spark, folder, "documents").select("doc_id", "text", F.xxhash64(shown).alias("_shown"))
    stored = materialize(pieces.encode_documents(documents, model, drop_text=True))
    back = pieces.decode_documents(stored.withColumn("_ids", F.col("ids")), model, ids="_ids", text="_text")
    return back.select("doc_id", "ids", "n_ids", "ids_crc32", (F.xxhash64("_text") == F.col("_shown")).alias("round_trips"))


URL_RULES = [
    url_filter.Rule("net", "/", url_filter.BLOCK),
    url_filter.Rule("example.net", "/en/", url_filter.ALLOW),
    url_filter.Rule("example.com", "/de/", url_filter.BLOCK),
    url_filter.Rule("org", "/fr/", url_filter.ALLOW),
]


def op10_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    judged = url_filter.judge_urls(_table(spark, folder, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op11_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every text, learnt from the languages outside one fold."""
    documents = _table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = language_id.fold(F.col("doc_id")) == language_id.HELD_OUT
    model = language_id.train(documents.where(~held_out))
    found = language_id.identify(documents.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op12_phrases(spark: SparkSession, folder: str) -> DataFrame:
    """The best 2000 collocations of each language, of phrases with 100 occurrences."""
    return phrases.mine_phrases(_table(spark, folder, "documents"), least=100, top=2000)


def op13_centroids(spark: SparkSession, folder: str) -> DataFrame:
    """Embeddings in 8 clusters after 10 rounds in integers."""
    found = centroids.cluster_vectors(_table(spark, folder, "embeddings"), clusters=8, rounds=10, seed=3)
    return found.drop("centroid")


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_store, op2_chat_format, op3_mixture, op4_vector_graph,
        op5_quality_classifier, op6_quality_rules, op7_warc, op8_ngram_join, op9_sentencepiece, op10_url_filter,
        op11_language_id, op12_phrases, op13_centroids,
    )
}
