"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tracklore.llm import chat, decontaminate, language_model, lexical, merkle, mixing, near_dedup, nearest, pii, quality, token_count, toxicity, url_filter


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_count": token_count.op1_token_count,
        "op2_pii": pii.op2_pii,
        "op3_decontaminate": decontaminate.op3_decontaminate,
        "op4_url_filter": url_filter.op4_url_filter,
        "op5_mixing": mixing.op5_mixing,
        "op6_near_dedup": near_dedup.op6_near_dedup,
        "op7_language_model": language_model.op7_language_model,
        "op8_quality": quality.op8_quality,
        "op9_toxicity": toxicity.op9_toxicity,
        "op10_nearest": nearest.op10_nearest,
        "op11_chat": chat.op11_chat,
        "op12_merkle": merkle.op12_merkle,
        "op13_lexical": lexical.op13_lexical,
    }


def oracle_sql() -> dict[str, str]:
    return {"op3_decontaminate": decontaminate.SQL, "op4_url_filter": url_filter.SQL, "op11_chat": chat.SQL, "op12_merkle": merkle.SQL, "op13_lexical": lexical.SQL}
