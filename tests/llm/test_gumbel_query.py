import zlib

from churnlab.llm import gumbel_pieces as G

from .helpers import SF, real_docs


def test_query_decodes_every_sample_to_its_text(spark):
    text = {r[0]: zlib.crc32((r[1] or "").encode()) for r in real_docs(spark)}
    rows = G.op5_gumbel_segmentations(spark, SF).select("doc_id", "text_crc32").collect()
    assert {r[0] for r in rows} == set(text) and all(r[1] == text[r[0]] for r in rows)
