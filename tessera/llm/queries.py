"""Registered queries of this subpackage: ``(spark, sf_dir) -> DataFrame``.

Each applies one operator, with production parameters, to its whole table.
"""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from . import langid, toxicity
from .bpe import encode
from .collocations import collocations
from .common import load, tokenizer_file
from .decontaminate import decontaminate
from .hyperminhash import near_duplicates
from .license_scan import license_scan
from .line_dedup import line_dedup
from .minhash import edit_fingerprints
from .oracle import SQL
from .periodic_runs import periodic_runs, planted
from .suffix_dedup import substring_dedup
from .token_counts import section_tokens
from .window_dedup import window_dedup

TOKENIZERS = os.path.dirname(tokenizer_file("word_bpe_49k.json"))


def op1_minhash_fingerprints(spark, d):
    return edit_fingerprints(load(spark, d, "documents"))


# Fixed value: the splitting pattern of the byte-level vocabulary.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def op2_section_token_counts(spark, d):
    return section_tokens(load(spark, d, "documents"), f"{TOKENIZERS}/byte_bpe_50k.tiktoken", BYTE_PATTERN)


def op3_noisy_channel_toxicity(spark, d):
    docs, labels = load(spark, d, "documents"), load(spark, d, "labels")
    model = toxicity.fit(docs, labels.where(~toxicity.held_out()))
    return toxicity.score(docs, model).select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def op4_suffix_array_dedup(spark, d):
    return substring_dedup(load(spark, d, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op5_ecoc_language_id(spark, d):
    docs = load(spark, d, "documents")
    model = langid.fit(docs.where(~langid.held_out()).select("lang", "text"))
    return langid.predict(docs, model).select(
        "doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "ambiguous")


def op6_rabin_karp_dedup(spark, d):
    return window_dedup(load(spark, d, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op7_transducer_bpe(spark, d):
    return encode(load(spark, d, "documents"), f"{TOKENIZERS}/word_bpe_49k.json").select(
        "doc_id", "n_tokens", F.sha2("ids_le", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_hyperminhash_dedup(spark, d):
    return near_duplicates(load(spark, d, "documents"))


def op9_license_scan(spark, d):
    return license_scan(load(spark, d, "documents")).drop("spans")


def op10_benchmark_decontamination(spark, d):
    return decontaminate(load(spark, d, "documents"), load(spark, d, "benchmark")).select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated",
        F.size("near_item_ids").cast("bigint").alias("n_near_items"))


def op11_phrase_collocations(spark, d):
    return collocations(load(spark, d, "documents"))


def op12_periodic_runs(spark, d):
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    return periodic_runs(load(spark, d, "documents"), change=planted).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli",
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_line_dedup(spark, d):
    return line_dedup(load(spark, d, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {name: fn for name, fn in list(globals().items()) if name.startswith("op") and callable(fn)}
