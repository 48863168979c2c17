"""Prompt of the assisted tier and the reading of its answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmweave.functions.scoring import two_decimals
from firmweave.functions.text import strip

MIN_CONFIDENCE = 0.5

# Fixed wording of the request.
_OPENING = "You are an expert at matching company records from websites to official business register entries."
_TASK = """TASK:
Determine which candidate (if any) is the best match for the website company. Consider:
1. Company name similarity (accounting for variations like "Pty Ltd", "Limited", etc.)
2. Industry/business type alignment
3. Location/state consistency if available
4. Overall context from the website

If NONE of the candidates are a good match, output "no_match".

OUTPUT FORMAT (JSON only):
{
  "matched_abn": "12345678901",
  "confidence": 0.85,
  "reasoning": "Strong name match with location confirmation"
}

OR if no match:
{
  "matched_abn": null,
  "confidence": 0.0,
  "reasoning": "No candidates match the website company"
}

JSON Response:"""


def _or_na(value: Column) -> Column:
    return F.coalesce(F.nullif(value, F.lit("")), F.lit("N/A"))


def _candidate_text(candidate: Column, index: Column) -> Column:
    def field(name: str) -> Column:
        return F.coalesce(candidate[name], F.lit("N/A"))

    return F.concat(
        (index + 1).cast("string"), F.lit(". ABN: "), candidate["abn"],
        F.lit("\n   Entity Name: "), candidate["entity_name"],
        F.lit("\n   Type: "), field("entity_type"),
        F.lit("\n   State: "), field("state"),
        F.lit("\n   Address: "), field("full_address"),
        F.lit("\n   Similarity Score: "), two_decimals(candidate["similarity"]), F.lit("\n"),
    )


def match_prompt(
    website_url: Column, name: Column, industry: Column, context: Column, candidates: Column
) -> Column:
    """Request text; ``candidates`` are structs with abn, entity_name, entity_type, state, full_address, similarity."""
    listed = F.array_join(F.transform(candidates, _candidate_text), "")
    return F.concat(
        F.lit(_OPENING + "\n\nWEBSITE INFORMATION:\n- URL: "), website_url,
        F.lit("\n- Company Name (from website): "), _or_na(name),
        F.lit("\n- Industry: "), _or_na(industry),
        F.lit("\n- Context: "), F.regexp_replace(_or_na(context), r"(?U)\s+\z", ""),
        F.lit("\n\n\nCANDIDATES FROM AUSTRALIAN BUSINESS REGISTER:\n"), listed,
        F.lit("\n\n" + _TASK),
    )


def with_match_prompt(df: DataFrame) -> DataFrame:
    """Add ``prompt`` to rows that carry the site columns and a ``candidates`` array."""
    return df.withColumn(
        "prompt",
        match_prompt(
            F.col("website_url"),
            F.col("scraped_company_name"),
            F.col("scraped_industry"),
            F.col("html_content_snippet"),
            F.col("candidates"),
        ),
    )


def parse_match_answer(answer: Column, min_confidence: float = MIN_CONFIDENCE) -> Column:
    """Struct (matched_abn, confidence, reasoning), or NULL when the answer is no match.

    Reads the first flat JSON object in the answer, so code fences do not matter.
    """
    found = F.regexp_extract(answer, r"\{[^{}]*\}", 0)
    said = F.from_json(found, "matched_abn string, confidence string, reasoning string")
    abn, stated = strip(said["matched_abn"]), said["confidence"].try_cast("double")
    confidence = F.when(stated > 1, F.lit(1.0)).otherwise(stated)
    none = said["matched_abn"].isin("null", "no_match", "")
    result = F.struct(
        abn.alias("matched_abn"),
        confidence.alias("confidence"),
        F.coalesce(said["reasoning"], F.lit("LLM determined match")).alias("reasoning"),
    )
    return F.when(said["matched_abn"].isNotNull() & ~none & (confidence >= min_confidence), result)


def offline_answer(candidates: Column) -> Column:
    """Answer of the built-in scorer: the top candidate, as sure as the names are alike."""
    top = F.get(candidates, 0)
    return F.to_json(
        F.struct(
            top["abn"].alias("matched_abn"),
            F.round(top["similarity"], 2).alias("confidence"),
            F.lit("Closest register name").alias("reasoning"),
        )
    )
