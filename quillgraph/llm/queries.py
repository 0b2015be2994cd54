"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from . import conversation_repair, html_text, infill, language, license_scan, media, mixing, packing, simhash, token_counts, topk, toxicity, url_filters

QUERIES = {
    f.__name__: f
    for f in (
        url_filters.op1_url_filters,
        license_scan.op2_license_scans,
        mixing.op3_mixing,
        token_counts.op4_token_counts,
        toxicity.op5_toxicity,
        media.op6_media_columns,
        simhash.op7_simhash,
        packing.op8_packing,
        topk.op9_top_k,
        html_text.op10_html_extraction,
        conversation_repair.op11_conversation_repair,
        infill.op12_fill_in_middle,
        language.op13_language_id,
    )
}

ORACLE_SQL = {"op1_url_filters": url_filters.ORACLE, "op9_top_k": topk.ORACLE, "op11_conversation_repair": conversation_repair.ORACLE, "op12_fill_in_middle": infill.ORACLE}
