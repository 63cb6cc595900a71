"""Declared schemas, as DDL."""

RECIPE_COLUMNS = {
    "name": "string",
    "id": "long",
    "minutes": "int",
    "contributor_id": "long",
    "submitted": "string",
    "tags": "string",
    "nutrition": "string",
    "n_steps": "int",
    "steps": "string",
    "description": "string",
    "ingredients": "string",
    "n_ingredients": "int",
    "nutrition_score": "double",
}

PAIRS = "id long, instruction string, output string"

BENCHMARK_RESULTS = (
    "model_name string, dish_name string, generation_time double, score double, "
    "reasoning string, recipe_length int, judge_model string"
)

TRAINING_LOG = (
    "log_history array<struct<epoch: double, grad_norm: double, learning_rate: double, "
    "loss: double, step: long, eval_loss: double, eval_runtime: double, "
    "eval_samples_per_second: double, eval_steps_per_second: double>>"
)
