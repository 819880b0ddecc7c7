"""The registered queries of the operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabulark.llm import (
    collocations,
    flat_graph,
    kmeans_tree,
    language,
    mixing,
    packing,
    partenum,
    piece_dropout,
    prefix_trie,
    sharding,
    style_tree,
    suffix_levels,
    token_counts,
)
from tabulark.llm.registry import query, table


@query("op1_token_counts")
def _(spark, sf):
    return token_counts.count_tokens(table(spark, sf, "documents"))


@query("op2_main_text")
def _(spark, sf):
    return style_tree.extract_main_text(table(spark, sf, "pages"))


@query("op3_kmeans_tree_search")
def _(spark, sf):
    return kmeans_tree.search(table(spark, sf, "embeddings"), F.col("id") % 20 == 0)


@query("op4_piece_dropout")
def _(spark, sf):
    return piece_dropout.encode_pieces(table(spark, sf, "documents"))


@query("op5_jaccard_join")
def _(spark, sf):
    return partenum.similar_sets(table(spark, sf, "documents"))


@query("op6_suffix_dedup")
def _(spark, sf):
    return suffix_levels.remove_repeats(table(spark, sf, "documents"))


@query("op7_language_id")
def _(spark, sf):
    docs = table(spark, sf, "documents")
    # a null id has no checksum: never trained on, and not of the held-out remainder
    held = F.coalesce(language.held_out(), F.lit(False))
    model = language.train_language_model(docs.where(~language.held_out()))
    found = language.predict_language(docs, model)
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score", "rejected")


@query("op8_jump_shards")
def _(spark, sf):
    return sharding.shard_rows(table(spark, sf, "documents"))


@query("op9_source_mix", mixing.SQL)
def _(spark, sf):
    return mixing.mix_sources(table(spark, sf, "documents"))


@query("op10_flat_graph_dedup")
def _(spark, sf):
    return flat_graph.near_duplicates(table(spark, sf, "embeddings"))


@query("op11_best_fit_packing")
def _(spark, sf):
    return packing.pack_documents(table(spark, sf, "documents"))


@query("op12_collocations", collocations.SQL)
def _(spark, sf):
    return collocations.mine_collocations(table(spark, sf, "documents"))


@query("op13_prefix_trie", prefix_trie.SQL)
def _(spark, sf):
    return prefix_trie.prefix_trie(table(spark, sf, "conversations"))
