"""The registered corpus queries and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from cdmspark.llm import (
    centroids,
    html_render,
    imatch,
    lang_id,
    license_scan,
    line_dedup,
    lm_score,
    near_dedup,
    packing,
    pieces,
    quality_net,
    quality_rules,
    token_align,
)

QUERIES = {
    "op1_near_dedup": near_dedup.op1_near_dedup,
    "op2_line_dedup": line_dedup.op2_line_dedup,
    "op3_pieces": pieces.op3_pieces,
    "op4_lm_score": lm_score.op4_lm_score,
    "op5_html_render": html_render.op5_html_render,
    "op6_lang_id": lang_id.op6_lang_id,
    "op7_license_scan": license_scan.op7_license_scan,
    "op8_imatch": imatch.op8_imatch,
    "op9_quality_rules": quality_rules.op9_quality_rules,
    "op10_packing": packing.op10_packing,
    "op11_byte_cnn": quality_net.op11_byte_cnn,
    "op12_token_align": token_align.op12_token_align,
    "op13_centroids": centroids.op13_centroids,
}

SQL: dict[str, str] = {
    "op2_line_dedup": line_dedup.OP2_SQL,
    "op13_centroids": centroids.OP13_SQL,
}
