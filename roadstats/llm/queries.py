"""Contract queries of the training-data operators and of the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpus_pipeline import run as pipeline
from roadstats.llm.bpe import op4_bpe
from roadstats.llm.collocations import op11_collocations
from roadstats.llm.decontaminate import op10_decontaminate
from roadstats.llm.langid import op12_langid
from roadstats.llm.licenses import op5_licenses
from roadstats.llm.negatives import op13_negatives
from roadstats.llm.quality import op1_quality
from roadstats.llm.rollups import op8_token_counts
from roadstats.llm.simhash import op3_simhash
from roadstats.llm.syncmers import op2_syncmers
from roadstats.llm.toxicity import op7_toxicity
from roadstats.llm.transcripts import op9_transcripts
from roadstats.llm.urls import op6_urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_syncmers": op2_syncmers,
    "op3_simhash": op3_simhash,
    "op4_bpe": op4_bpe,
    "op5_licenses": op5_licenses,
    "op6_urls": op6_urls,
    "op7_toxicity": op7_toxicity,
    "op8_token_counts": op8_token_counts,
    "op9_transcripts": op9_transcripts,
    "op10_decontaminate": op10_decontaminate,
    "op11_collocations": op11_collocations,
    "op12_langid": op12_langid,
    "op13_negatives": op13_negatives,
    "pipeline": pipeline,
}
