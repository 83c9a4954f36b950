"""Named queries and their DuckDB oracles, one entry per operator group."""

from __future__ import annotations

from . import curation_queries as cq
from . import evaluation as ev
from . import guard_queries as gq
from . import lineage_queries as lq
from . import metric_queries as mq
from . import retrieval_queries as rq
from . import timeseries_queries as tq
from . import verdict_queries as vq

QUERIES = {
    "leaderboard_basic": ev.leaderboard_basic,
    "exact_match_trim": ev.exact_match_trim,
    "judge_first_token": vq.judge_first_token,
    "judge_capped": vq.judge_capped,
    "judge_plain": vq.judge_plain,
    "judge_int": vq.judge_int,
    "toxicity_verdict": vq.toxicity_verdict,
    "quality_verdict": vq.quality_verdict,
    "accept_verdict": vq.accept_verdict,
    "pass_verdict": vq.pass_verdict,
    "hallucination_rate": vq.hallucination_rate,
    "retrieve_topk": rq.retrieve_topk,
    "rag_precision_recall": rq.rag_precision_recall,
    "rag_k_sweep": rq.rag_k_sweep,
    "rag_context": rq.rag_context,
    "rag_id_lists": rq.rag_id_lists,
    "cosine_pairs": rq.cosine_pairs,
    "similarity_threshold": rq.similarity_threshold,
    "parse_generated": cq.parse_generated,
    "parse_errors": cq.parse_errors,
    "format_filter": cq.format_filter,
    "length_filter": cq.length_filter,
    "schema_validate": cq.schema_validate,
    "dedup_exact": cq.dedup_exact,
    "curation_funnel": cq.curation_funnel,
    "scenario_counts": cq.scenario_counts,
    "assign_ids": cq.assign_ids,
    "short_key": cq.short_key,
    "review_sample": cq.review_sample,
    "apply_decisions": cq.apply_decisions,
    "extend_dataset": cq.extend_dataset,
    "tag_rows": cq.tag_rows,
    "injection_scan": gq.injection_scan,
    "policy_scan": gq.policy_scan,
    "guardrail_flow": gq.guardrail_flow,
    "guardrail_sample": gq.guardrail_sample,
    "category_extract": gq.category_extract,
    "prompt_accuracy": gq.prompt_accuracy,
    "prompt_render": gq.prompt_render,
    "price_stats": tq.price_stats,
    "recent_prices": tq.recent_prices,
    "quotes": tq.quotes,
    "financials": tq.financials,
    "batch_requests": tq.batch_requests,
    "lineage_ancestors": lq.lineage_ancestors,
    "latest_versions": lq.latest_versions,
    "eval_inputs": lq.eval_inputs,
    "artifact_metadata": lq.artifact_metadata,
    "run_metrics_last": lq.run_metrics_last,
    "file_manifest_counts": lq.file_manifest_counts,
    "conversation_history": lq.conversation_history,
    "predict_constant": lq.predict_constant,
    "explode_lines": lq.explode_lines,
    "bleu_sentence": mq.bleu_sentence,
    "rouge_l": mq.rouge_l,
    "stem_dictionary": mq.stem_dictionary,
    "bertscore": mq.bertscore,
    "benchmark_leaderboard": mq.benchmark_leaderboard,
    "benchmark_board": mq.benchmark_board,
    "metric_board": mq.metric_board,
    "dedup_near": cq.dedup_near,
    "guardrail_stream": gq.guardrail_stream,
    "lineage_descendants": lq.lineage_descendants,
    "publish_versions": lq.publish_versions,
    "lineage_edges": lq.lineage_edges,
    "version_diff": lq.version_diff,
}

ORACLE_SQL = {
    "leaderboard_basic": ev.LEADERBOARD_BASIC_SQL,
    "exact_match_trim": ev.EXACT_MATCH_TRIM_SQL,
    "judge_first_token": vq.JUDGE_FIRST_TOKEN_SQL,
    "judge_capped": vq.JUDGE_CAPPED_SQL,
    "judge_plain": vq.JUDGE_PLAIN_SQL,
    "judge_int": vq.JUDGE_INT_SQL,
    "toxicity_verdict": vq.TOXICITY_VERDICT_SQL,
    "quality_verdict": vq.QUALITY_VERDICT_SQL,
    "accept_verdict": vq.ACCEPT_VERDICT_SQL,
    "pass_verdict": vq.PASS_VERDICT_SQL,
    "hallucination_rate": vq.HALLUCINATION_RATE_SQL,
    "retrieve_topk": rq.RETRIEVE_TOPK_SQL,
    "rag_precision_recall": rq.RAG_PRECISION_RECALL_SQL,
    "rag_k_sweep": rq.RAG_K_SWEEP_SQL,
    "rag_context": rq.RAG_CONTEXT_SQL,
    "rag_id_lists": rq.RAG_ID_LISTS_SQL,
    "cosine_pairs": rq.COSINE_PAIRS_SQL,
    "similarity_threshold": rq.SIMILARITY_THRESHOLD_SQL,
    "parse_generated": cq.PARSE_GENERATED_SQL,
    "parse_errors": cq.PARSE_ERRORS_SQL,
    "format_filter": cq.FORMAT_FILTER_SQL,
    "length_filter": cq.LENGTH_FILTER_SQL,
    "schema_validate": cq.SCHEMA_VALIDATE_SQL,
    "dedup_exact": cq.DEDUP_EXACT_SQL,
    "curation_funnel": cq.CURATION_FUNNEL_SQL,
    "scenario_counts": cq.SCENARIO_COUNTS_SQL,
    "assign_ids": cq.ASSIGN_IDS_SQL,
    "short_key": cq.SHORT_KEY_SQL,
    "review_sample": cq.REVIEW_SAMPLE_SQL,
    "apply_decisions": cq.APPLY_DECISIONS_SQL,
    "extend_dataset": cq.EXTEND_DATASET_SQL,
    "tag_rows": cq.TAG_ROWS_SQL,
    "injection_scan": gq.INJECTION_SCAN_SQL,
    "policy_scan": gq.POLICY_SCAN_SQL,
    "guardrail_flow": gq.GUARDRAIL_FLOW_SQL,
    "guardrail_sample": gq.GUARDRAIL_SAMPLE_SQL,
    "category_extract": gq.CATEGORY_EXTRACT_SQL,
    "prompt_accuracy": gq.PROMPT_ACCURACY_SQL,
    "prompt_render": gq.PROMPT_RENDER_SQL,
    "price_stats": tq.PRICE_STATS_SQL,
    "recent_prices": tq.RECENT_PRICES_SQL,
    "quotes": tq.QUOTES_SQL,
    "financials": tq.FINANCIALS_SQL,
    "batch_requests": tq.BATCH_REQUESTS_SQL,
    "lineage_ancestors": lq.LINEAGE_ANCESTORS_SQL,
    "latest_versions": lq.LATEST_VERSIONS_SQL,
    "eval_inputs": lq.EVAL_INPUTS_SQL,
    "artifact_metadata": lq.ARTIFACT_METADATA_SQL,
    "run_metrics_last": lq.RUN_METRICS_LAST_SQL,
    "file_manifest_counts": lq.FILE_MANIFEST_COUNTS_SQL,
    "conversation_history": lq.CONVERSATION_HISTORY_SQL,
    "predict_constant": lq.PREDICT_CONSTANT_SQL,
    "explode_lines": lq.EXPLODE_LINES_SQL,
    "bleu_sentence": mq.BLEU_SENTENCE_SQL,
    "stem_dictionary": mq.STEM_DICTIONARY_SQL,
    "bertscore": mq.BERTSCORE_SQL,
    "benchmark_board": mq.BENCHMARK_BOARD_SQL,
    "guardrail_stream": gq.GUARDRAIL_STREAM_SQL,
    "lineage_descendants": lq.LINEAGE_DESCENDANTS_SQL,
    "publish_versions": lq.PUBLISH_VERSIONS_SQL,
    "lineage_edges": lq.LINEAGE_EDGES_SQL,
    "version_diff": lq.VERSION_DIFF_SQL,
}
