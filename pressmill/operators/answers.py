"""From hits to answers: context block, prompt, completion, sources."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressmill.operators.retrieval import limit_error

# The texts an answer is made of.
SYSTEM_PROMPT = (
    "You are a news analyst. Answer user questions using ONLY the provided context. "
    "Cite source URLs. If the context is insufficient, say "
    "\"I don't have enough information.\""
)
NO_ANSWER = "I don't have enough information."
STUB_BANNER = "[stub llm] No LLM was called (LLM_PROVIDER=stub). "
UNTITLED = "Untitled"
SEPARATOR = "\n\n---\n\n"

DEFAULT_PROVIDER = "stub"
CompleteBatch = Callable[[list[str], list[str]], list[str]]
_COMPLETERS: dict[str, CompleteBatch] = {}


def register_completer(name: str, complete: CompleteBatch) -> None:
    """Add a provider: ``complete(system prompts, user prompts) -> answers``."""
    _COMPLETERS[name] = complete


def context_block(docs: Column) -> Column:
    """Numbered blocks of an array of ``struct<rank,url,title,chunk_text>`` in
    rank order; an empty array gives ``''``."""
    blocks = F.transform(
        docs,
        lambda d, i: F.concat(
            F.lit("["),
            (i + 1).cast("string"),
            F.lit("] "),
            F.coalesce(F.nullif(d["title"], F.lit("")), F.lit(UNTITLED)),
            F.lit("\nURL: "),
            d["url"],
            F.lit("\n"),
            d["chunk_text"],
        ),
    )
    return F.array_join(blocks, SEPARATOR)


def contexts(hits: DataFrame) -> DataFrame:
    """``question_id, context, sources``; a question has at most 100 hits."""
    docs = F.array_sort(F.collect_list(F.struct("rank", "url", "title", "chunk_text")))
    grouped = hits.groupBy("question_id").agg(docs.alias("_docs"))
    return grouped.select(
        "question_id",
        context_block(F.col("_docs")).alias("context"),
        F.transform("_docs", lambda d: d["url"]).alias("sources"),
    )


def user_prompt(context: Column, question: Column) -> Column:
    return F.concat(F.lit("Context:\n"), context, F.lit("\n\nQuestion: "), question)


def prompts(questions: DataFrame, hits: DataFrame) -> DataFrame:
    """Every question with ``system, prompt, sources``; no hits, null prompt."""
    found = questions.join(contexts(hits), "question_id", "left")
    return found.select(
        *questions.columns,
        F.lit(SYSTEM_PROMPT).alias("system"),
        user_prompt(F.col("context"), F.col("text")).alias("prompt"),
        F.coalesce("sources", F.array().cast("array<string>")).alias("sources"),
    )


def stub_completion(prompt: Column) -> Column:
    """The prompt given back below a banner; no model is called."""
    return F.concat(F.lit(STUB_BANNER + "\n\n"), prompt)


_RESULT = T.StructType([T.StructField("answer", T.StringType()), T.StructField("error", T.StringType())])
#: Characters of an error message kept in the error column.
ERROR_CHARS = 500


def completion_of(system: Column, prompt: Column, provider: Column) -> Column:
    """``struct<answer, error>`` by provider name; an unknown name is an error of the job.

    Registered providers are called with Arrow batches of their own rows only.
    """
    out = F.when(provider == DEFAULT_PROVIDER, F.struct(stub_completion(prompt).alias("answer"), F.lit(None).cast("string").alias("error")))
    for name, complete in _COMPLETERS.items():
        mine = F.when(provider == name, prompt)
        out = out.when(provider == name, _call(complete)(system, mine))
    unknown = F.concat(F.lit("unknown completion provider: '"), provider, F.lit("'"))
    return out.otherwise(F.raise_error(unknown).cast(_RESULT))


def _call(complete: CompleteBatch):
    """A completer over Arrow batches. A batch that fails is halved until the
    prompts that fail alone are found; those get an error and no answer, the
    rest their answers."""

    @F.arrow_udf(_RESULT)
    def run(system: pa.Array, prompt: pa.Array) -> pa.Array:
        answers: list[str | None] = [None] * len(prompt)
        errors: list[str | None] = [None] * len(prompt)
        todo = [[i for i, p in enumerate(prompt) if p.is_valid]]
        while todo:
            at = todo.pop()
            if not at:
                continue
            try:
                given = complete([system[i].as_py() for i in at], [prompt[i].as_py() for i in at])
                if len(given) != len(at):
                    raise ValueError(f"expected {len(at)} completions, got {len(given)}")
            except Exception as error:  # noqa: BLE001 - one prompt's failure must not end the job
                if len(at) == 1:
                    errors[at[0]] = f"completion_failed: {type(error).__name__}: {error}"[:ERROR_CHARS]
                else:
                    todo += [at[len(at) // 2 :], at[: len(at) // 2]]
                continue
            for i, text in zip(at, given):
                answers[i] = text or ""
        return pa.StructArray.from_arrays([pa.array(answers, pa.string()), pa.array(errors, pa.string())], ["answer", "error"])

    return run


def answers(questions: DataFrame, hits: DataFrame, provider: str = DEFAULT_PROVIDER, errors: bool = False) -> DataFrame:
    """``question_id, answer, sources`` for every question, and ``error`` if asked.

    A question's own ``provider`` wins over the default. Without hits no
    completion is made and the fixed text is given. A completion that fails,
    or a question's own ``top_k`` outside 1..100, costs that question only:
    answer null, and the reason in ``error``.
    """
    if provider != DEFAULT_PROVIDER and provider not in _COMPLETERS:
        raise ValueError(f"unknown completion provider: {provider!r}")
    asked = prompts(questions, hits)
    own = F.col("provider") if "provider" in asked.columns else F.lit(None).cast("string")
    chosen = F.coalesce(own, F.lit(provider))
    refused = limit_error(asked)
    done = asked.withColumn("_done", F.when(F.col("prompt").isNotNull(), completion_of(F.col("system"), F.col("prompt"), chosen)))
    answer = F.when(refused.isNotNull(), F.lit(None).cast("string")).when(F.col("prompt").isNull(), F.lit(NO_ANSWER))
    return done.select(
        "question_id",
        answer.otherwise(F.col("_done.answer")).alias("answer"),
        "sources",
        *([F.coalesce(refused, F.col("_done.error")).alias("error")] if errors else []),
    )
