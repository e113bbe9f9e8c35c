import pytest

from tidecall.llm.queries import QUERIES

COLUMNS = {
    "op1": ["doc_id", "n_shingles", "component_id"],
    "op2": ["doc_id", "item_id", "start_word", "n_words", "similarity"],
    "op3": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    "op4": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op5": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op6": ["doc_id", "held_out", "score", "predicted"],
    "op7": ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
    "op8": ["doc_id", "n_lines", "n_removed", "text"],
    "op9": ["doc_id", "held_out", "lang_pred", "score"],
    "op10": ["page_id", "host", "path", "rule", "verdict"],
    "op11": ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"],
    "op12": ["query_id", "rank", "vec_id", "score"],
    "op13": ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"],
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_whole_tables_and_columns(spark, small, name):
    df = QUERIES[name](spark, small)
    columns = COLUMNS[name.split("_")[0]]
    assert [c for c in df.columns if c in columns] == columns
    source = {"op10": "pages", "op12": "embeddings", "op13": "embeddings"}.get(name.split("_")[0], "documents")
    rows = spark.read.parquet(f"{small}/{source}.parquet").count()
    one_per_row = name.split("_")[0] not in ("op2", "op3", "op12")
    assert df.count() == rows if one_per_row else df.count() > 0
