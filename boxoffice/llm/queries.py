"""The operators' registered queries, over whole tables with production parameters."""

from boxoffice.llm import (ann, bpe, centroids, chat, fertility, fingerprints, langid, licenses, packing, quality,
                           simhash, spelling, toxicity)

REGISTRY = {
    "op1_quality": quality.op1_quality,
    "op2_chat_formatting": chat.op2_chat_formatting,
    "op3_document_fingerprints": fingerprints.op3_document_fingerprints,
    "op4_license_scan": licenses.op4_license_scan,
    "op5_packing": packing.op5_packing,
    "op6_simhash": simhash.op6_simhash,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_language_id": langid.op8_language_id,
    "op9_nearest_neighbours": ann.op9_nearest_neighbours,
    "op10_byte_bpe": bpe.op10_byte_bpe,
    "op11_spelling_variants": spelling.op11_spelling_variants,
    "op12_quality_rules": fertility.op12_quality_rules,
    "op13_centroid_clustering": centroids.op13_centroid_clustering,
}

ORACLE_SQL = {
    "op2_chat_formatting": chat.OP2_SQL,
    "op4_license_scan": licenses.OP4_SQL,
    "op13_centroid_clustering": centroids.OP13_SQL,
}
