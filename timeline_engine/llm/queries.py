"""The queries of this subpackage and, where SQL can state one, its oracle."""

from . import drake_kmeans, hilbert_pack, html_crf, importance, license_scan, line_dedup, mixing, parity_join, pu_toxicity, quality_rules, url_filter, warc_dict, winnowing

QUERIES = {
    "op1_html_extraction": html_crf.op1_html_extraction,
    "op2_packing": hilbert_pack.op2_packing,
    "op3_url_filter": url_filter.op3_url_filter,
    "op4_quality_rules": quality_rules.op4_quality_rules,
    "op5_winnowing": winnowing.op5_winnowing,
    "op6_ngram_jaccard": parity_join.op6_ngram_jaccard,
    "op7_warc": warc_dict.op7_warc,
    "op8_toxicity": pu_toxicity.op8_toxicity,
    "op9_line_dedup": line_dedup.op9_line_dedup,
    "op10_mixing": mixing.op10_mixing,
    "op11_license_scan": license_scan.op11_license_scan,
    "op12_centroids": drake_kmeans.op12_centroids,
    "op13_importance": importance.op13_importance,
}

ORACLE_SQL = {
    "op3_url_filter": url_filter.OP3_SQL,
    "op7_warc": warc_dict.OP7_SQL,
    "op9_line_dedup": line_dedup.OP9_SQL,
    "op10_mixing": mixing.OP10_SQL,
    "op12_centroids": drake_kmeans.OP12_SQL,
    "op13_importance": importance.OP13_SQL,
}
