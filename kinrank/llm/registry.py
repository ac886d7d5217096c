"""Queries and SQL of the corpus operators: ``opN_<name>``."""

from __future__ import annotations

from kinrank.llm import (bpe, conversations, debruijn, jaccard, langid, lines, mixing, packing, quality, rules, search,
                         simhash, suffixes)


def queries() -> dict:
    return {
        "op1_pack": packing.q_pack,
        "op2_jaccard": jaccard.q_jaccard,
        "op3_line_dedup": lines.q_line_dedup,
        "op4_bpe": bpe.q_bpe,
        "op5_language": langid.q_language,
        "op6_substring": debruijn.q_substring,
        "op7_quality": quality.q_quality,
        "op8_simhash": simhash.q_simhash,
        "op9_suffix": suffixes.q_suffix,
        "op10_host_rules": rules.q_host_rules,
        "op11_conversations": conversations.q_conversations,
        "op12_search": search.q_search,
        "op13_mixing": mixing.q_mixing,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_jaccard": jaccard.SQL,
        "op3_line_dedup": lines.SQL,
        "op6_substring": debruijn.SQL,
        "op9_suffix": suffixes.SQL,
        "op10_host_rules": rules.SQL,
        "op11_conversations": conversations.SQL,
        "op12_search": search.SQL,
    }
