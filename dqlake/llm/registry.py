"""The queries of this subpackage and their SQL twins."""

from __future__ import annotations

from dqlake.llm import exact, hnsw, line_dedup, merkle, mixing, phrases, pieces, quality, simhash, suffix, topk, toxicity, warc

QUERIES = {
    "op1_sentencepiece": pieces.op1_sentencepiece,
    "op2_top_k": topk.op2_top_k,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_suffix_dedup": suffix.op4_suffix_dedup,
    "op5_warc": warc.op5_warc,
    "op6_mix_sources": mixing.op6_mix_sources,
    "op7_quality": quality.op7_quality,
    "op8_line_dedup": line_dedup.op8_line_dedup,
    "op9_simhash": simhash.op9_simhash,
    "op10_hnsw": hnsw.op10_hnsw,
    "op11_exact_dedup": exact.op11_exact_dedup,
    "op12_collocations": phrases.op12_collocations,
    "op13_merkle": merkle.op13_merkle,
}

ORACLE_SQL = {
    "op2_top_k": topk.SQL,
    "op5_warc": warc.SQL,
    "op6_mix_sources": mixing.SQL,
    "op8_line_dedup": line_dedup.SQL,
    "op11_exact_dedup": exact.SQL,
    "op12_collocations": phrases.SQL,
    "op13_merkle": merkle.SQL,
}
