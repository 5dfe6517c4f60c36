"""Sample-generation jobs over tables of prompts, and the evaluation of their answers."""

from sampleflow.plans.evaluation import evaluate_answers, score_prompts
from sampleflow.plans.generation import (
    preview_generation,
    run_all_splits,
    run_generation,
    run_incremental,
    run_with_stats,
)
from sampleflow.spec import (
    DataOptions,
    JobSpec,
    RetryOptions,
    SamplingOptions,
    SplitOptions,
)

__all__ = [
    "DataOptions",
    "JobSpec",
    "RetryOptions",
    "SamplingOptions",
    "SplitOptions",
    "evaluate_answers",
    "preview_generation",
    "run_all_splits",
    "run_generation",
    "run_incremental",
    "run_with_stats",
    "score_prompts",
]
