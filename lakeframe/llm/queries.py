"""Registered queries of the corpus operators, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeframe.session import read_table

from . import (alignment, exact_dedup, jaccard_join, language_id, mixing, packing, secret_scan, sharding, simhash, sketches, suffix_dedup,
               url_filter, whitening)


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(read_table(spark, sf_dir, "documents"), **mixing.QUERY)
    return mixed.select("doc_id", "source", "tokens", "weight", "epoch", "block", "slot")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_dedup(read_table(spark, sf_dir, "documents"), words_per_shingle=3, radius=2)
    return found.select("doc_id", "fingerprint", "component_id")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_dedup(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op5_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.train(docs))


def op3_reshard(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = sharding.reshard(read_table(spark, sf_dir, "documents"), shards=40)
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    return layout.rows.select(
        "doc_id", F.col(sharding.SIZE).alias("size"), crc.alias("text_crc32"), F.lit("bytes").alias("law"),
        F.col(sharding.SHARD).alias("shard"), F.col(sharding.SLOT).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        F.col(sharding.OLD).alias("old_shard"))


def op7_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.edited_fingerprints(read_table(spark, sf_dir, "documents"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(read_table(spark, sf_dir, "documents")))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents")))


# Rules of the query: fixed values.
URL_RULES = [url_filter.Rule("allow", "com/"), url_filter.Rule("block", "example.com/en/"),
             url_filter.Rule("allow", "www.example.com/en/"), url_filter.Rule("block", "net/es/"), url_filter.Rule("block", "net/fr/")]

# The small labelled table: fixed topics, each in all forms of address, which hold the same neutral words for both labels.
BLOCK_TOPICS = ("pills diet-pills viagra cialis steroids pharma-discount casino casino-bonus roulette jackpot poker slots betting bets free-spins wager "
                "lottery porn xxx adult adult-video camgirls nude-chat escorts hookup payday fast-loans get-rich crypto-doubler replica counterfeit "
                "fake-id keygen warez crackz serials spam spam-mail linkfarm popups adserver ads track-ads clicktrack malware phishing botnet").split()
ALLOW_TOPICS = ("news wiki docs library university museum science history recipes weather gardening travel music health council archive "
                "encyclopedia textbooks journal research sports film language school hospital parish orchestra theatre bakery bicycle astronomy botany "
                "chemistry geology physics mathematics poetry painting pottery railway windfarm market kitchen carpentry knitting birds hiking chess "
                "athletics software database winter adventure better alphabet track-and-field free-library loanword packages").split()
NEUTRAL = "north river blue stone maple seven delta green hill lake sunny bright apex omega nova central west amber coast field".split()
FORMS = ["http://{0}.biz/", "https://www.{1}-{0}.info/index.php?id=7", "http://{0}{1}.co.uk/{2}", "https://{1}.org/~staff/{0}.html", "http://shop.{0}-{1}.de/",
         "https://{0}.{1}.io/2024/05/{2}", "http://{1}.edu/{0}/{2}", "https://my{0}.net/", "http://www.{0}24.fr/{2}/page/3", "https://{1}{0}.eu/#top",
         "http://10.0.0.7/{0}/{2}", "https://{0}-{2}.com", "http://cdn.{1}.tv/{2}/{0}.jpg", "https://blog.{0}.us/{1}",
         "https://m.{1}-{0}.it/"]


def labelled_urls(spark: SparkSession) -> DataFrame:
    rows = []
    for topics, block in ((BLOCK_TOPICS, True), (ALLOW_TOPICS, False)):
        for i, topic in enumerate(topics):
            for j, form in enumerate(FORMS):
                k = 3 * i + 7 * j
                rows.append((form.format(topic, NEUTRAL[k % len(NEUTRAL)], NEUTRAL[(k + 5) % len(NEUTRAL)]), block))
    return spark.createDataFrame(rows, "url string, block boolean")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read_table(spark, sf_dir, "pages"), URL_RULES, url_filter.train(labelled_urls(spark)))


def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.jaccard_join(read_table(spark, sf_dir, "documents"), words=3, percent=90)
    return found.select("doc_id", "n_shingles", "component_id")


def op12_align_tokenizers(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alignment.align(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                            public_tokenizers.path("piece_bpe_32k.model"))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"), components=32)


QUERIES = {f.__name__: f for f in (op1_mix_sources, op2_simhash, op3_reshard, op4_exact_dedup, op5_pack, op6_language_id, op7_sketches,
                                   op8_secret_scan, op9_suffix_dedup, op10_url_filter, op11_jaccard_join, op12_align_tokenizers, op13_whitening)}

ORACLES = {"op1_mix_sources": mixing.ORACLE, "op4_exact_dedup": exact_dedup.ORACLE, "op8_secret_scan": secret_scan.oracle(),
           "op9_suffix_dedup": suffix_dedup.ORACLE, "op11_jaccard_join": jaccard_join.ORACLE}
