"""Queries of the corpus operators and, where SQL can express one, its DuckDB SQL."""
from __future__ import annotations

from gridlake.llm.bpe import op3_byte_bpe
from gridlake.llm.decontaminate import op2_decontaminate
from gridlake.llm.embedding_dedup import op7_embedding_dedup
from gridlake.llm.exact_dedup import op11_exact_dedup
from gridlake.llm.exact_dedup import oracle as exact_oracle
from gridlake.llm.license_scan import op1_license_scan
from gridlake.llm.license_scan import oracle as license_oracle
from gridlake.llm.merkle import op13_merkle_manifest
from gridlake.llm.merkle import oracle as merkle_oracle
from gridlake.llm.near_dedup import op5_near_dedup
from gridlake.llm.ranked_search import op12_ranked_search
from gridlake.llm.ranked_search import oracle as search_oracle
from gridlake.llm.secret_scan import op6_secret_scan
from gridlake.llm.sharding import op9_sharding
from gridlake.llm.sharding import oracle as sharding_oracle
from gridlake.llm.substring_dedup import op8_substring_dedup
from gridlake.llm.suffix_dedup import op10_suffix_dedup
from gridlake.llm.toxicity import op4_toxicity


def queries() -> dict:
    return {f.__name__: f for f in (
        op1_license_scan, op2_decontaminate, op3_byte_bpe, op4_toxicity, op5_near_dedup,
        op6_secret_scan, op7_embedding_dedup, op8_substring_dedup, op9_sharding, op10_suffix_dedup,
        op11_exact_dedup, op12_ranked_search, op13_merkle_manifest)}


def oracle_sql() -> dict[str, str]:
    return {"op1_license_scan": license_oracle(), "op9_sharding": sharding_oracle(), "op11_exact_dedup": exact_oracle(),
            "op12_ranked_search": search_oracle(), "op13_merkle_manifest": merkle_oracle()}
