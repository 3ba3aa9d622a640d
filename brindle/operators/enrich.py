"""Enrichment by a language model behind a provider: prompts, checks, retries, budget."""

from __future__ import annotations

import hashlib
import json
import os
import re
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import answers
from ..functions.scores import popularity
from ..functions.text import bound, estimate_tokens, feature_text, smart_truncate
from .progress import admitted


@dataclass(frozen=True)
class Request:
    prompt: str
    temperature: float = 0.2
    max_tokens: int = 256
    system: str = ""


class Provider:
    """Answers prompts; None where there is no answer."""

    def call(self, request: Request) -> str | None:
        raise NotImplementedError


class Offline(Provider):
    """The same answer to the same prompt, without a network."""

    def call(self, request: Request) -> str | None:
        pick = int(hashlib.sha256(request.prompt.encode()).hexdigest()[:8], 16)
        task = request.system
        if task == "classification":
            return answers.CATEGORIES[pick % len(answers.CATEGORIES)]
        if task == "score":
            return f"Score: {pick % 101 / 10}"
        if task == "extraction":
            wanted = json.loads(request.prompt.partition(": ")[2].splitlines()[0])
            return "Here it is: " + json.dumps({k: request.prompt.splitlines()[-1][:40] for k in wanted})
        if task == "factual_pairs":
            return "\n".join(f"✅ Factual: fact {k}\n❌ Counterfactual: not fact {k}" for k in range(3))
        return request.prompt.strip().splitlines()[-1][:200] if request.prompt.strip() else None


class Endpoint(Provider):
    """A chat endpoint over HTTP; its key comes from the environment only."""

    def __init__(self, url: str, model: str, key_variable: str = "LLM_API_KEY", timeout: float = 30.0):
        self.url, self.model, self.key_variable, self.timeout = url, model, key_variable, timeout

    def call(self, request: Request) -> str | None:
        body = {"model": self.model, "messages": [{"role": "system", "content": request.system}, {"role": "user", "content": request.prompt}], "temperature": request.temperature, "max_tokens": request.max_tokens}
        asked = urllib.request.Request(self.url, json.dumps(body).encode(), {"Content-Type": "application/json", "Authorization": "Bearer " + os.environ.get(self.key_variable, "")})
        try:
            with urllib.request.urlopen(asked, timeout=self.timeout) as answer:
                return json.load(answer)["choices"][0]["message"]["content"]
        except (OSError, ValueError, KeyError, IndexError):
            return None


#: Hosted providers need a key; local ones a URL.
HOSTED, LOCAL = ("openai", "azure", "anthropic", "google"), {"ollama": "http://localhost:11434/v1", "lmstudio": "http://localhost:1234/v1"}


@dataclass(frozen=True)
class Settings:
    provider: str = "offline"
    model: str = ""
    url: str = ""
    max_tokens: int = 256
    token_limit: int = 4096
    retries: int = 3
    budget: float = 90.0
    cost_per_token: float = 0.0


def provider_of(settings: Settings) -> Provider:
    """A provider for the settings; a missing key or an unknown name is an error here, on the driver."""
    if settings.provider == "offline":
        return Offline()
    if settings.provider in HOSTED and not os.environ.get("LLM_API_KEY"):
        raise ValueError(f"{settings.provider} needs LLM_API_KEY")
    url = settings.url or LOCAL.get(settings.provider, "")
    if not url:
        raise ValueError(f"no URL for provider {settings.provider}")
    return Endpoint(url.rstrip("/") + "/chat/completions", settings.model)


@dataclass(frozen=True)
class Retry:
    """Attempts, how the temperature changes, and whether the last answer stands even if it is not valid."""

    attempts: int = 4
    temperature: Callable[[float, int], float] = field(default=lambda t, i: t)
    keep_last: bool = False
    simplify_from: int = 99


RETRIES = {"local": Retry(4, lambda t, i: t * (1 + 0.2 * i), True, 2), "hosted": Retry(4, lambda t, i: min(0.8, t + 0.1 * i)), "unified": Retry(4)}


def local_prompt(prompt: str, margin: int = 3000, characters: int = 4) -> str:
    """A prompt cut for a local model: 100 tokens below the margin, by the estimate of four characters a token."""
    return prompt[: max(margin - 100, 0) * characters]


def extraction_prompt(content: Column, fields: dict[str, str], most: int = 4000) -> Column:
    """Asks for a JSON object with the given fields of a page."""
    wanted = json.dumps(fields, sort_keys=True)
    return F.concat(F.lit(f"Extract a JSON object with these fields and nothing else: {wanted}\n\n"), F.substring(content, 1, most))


def extracted(pages: DataFrame, fields: dict[str, str], settings: Settings = Settings(), key: str = "name", content: str = "content") -> DataFrame:
    """Pages with ``structured_data``: what the model extracts under the fields, ``{}`` where its answer is no JSON object."""
    asked = pages.select(F.col(key).alias("name"), F.lit("extraction").alias("task"), extraction_prompt(F.coalesce(content, F.lit("")), fields).alias("prompt")).withColumn("tokens", estimate_tokens(F.col("prompt")))
    found = answered(asked, settings, cost_per_token=settings.cost_per_token).groupBy("name").agg(F.max("answer").alias("_answer")).withColumnRenamed("name", "_name")
    schema = ", ".join(f"`{k}` {v}" for k, v in sorted(fields.items()))
    data = F.to_json(F.from_json(F.regexp_extract("_answer", r"(?s)\{.*\}", 0), schema))
    return pages.join(found, F.col(key) == F.col("_name"), "left").withColumn("structured_data", F.coalesce(data, F.lit("{}"))).drop("_name", "_answer")


def with_retries(call: Callable[[Request], str | None], request: Request, valid: Callable[[str], bool], policy: Retry) -> str | None:
    last = None
    for i in range(policy.attempts):
        prompt = re.sub(r"\s+", " ", request.prompt) if i >= policy.simplify_from else request.prompt
        last = call(Request(prompt, policy.temperature(request.temperature, i), request.max_tokens, request.system))
        if last and valid(last):
            return last
    return last if policy.keep_last else None


def _valid(task: str, text: str) -> bool:
    if task == "classification":
        return any(c.lower() in text.lower() for c in answers.CATEGORIES)
    if task == "factual_pairs":
        return "✅" in text and "❌" in text
    if task == "score":
        return re.search("[0-9]", text) is not None
    return bool(text.strip())


def prompts(packages: DataFrame, settings: Settings = Settings(), gating: str = "local") -> DataFrame:
    """``name, task, prompt, tokens``: the prompts each package gets.

    Gating: ``local`` asks everything, the summary only of a readme; ``hosted`` asks facts and score always, summary and
    use case of a readme, no features; ``unified`` asks nothing without a readme.
    """
    readme = F.coalesce("readme", F.lit(""))
    has = readme != ""
    short = smart_truncate(readme, settings.token_limit * 6 // 10)
    about = F.concat_ws("\n", F.concat(F.lit("Package: "), F.col("name")), F.coalesce("description", F.lit("")))
    yes = F.lit(True)
    when = {"local": (has, yes, yes, yes, yes), "hosted": (has, F.lit(False), has, yes, yes), "unified": (has, has, has, has, has)}[gating]
    texts = lambda short: (F.concat_ws("\n", F.lit("Summarise this readme."), about, short), F.concat_ws("\n", F.lit("Explain these features."), about, feature_text(F.col("features"))), F.concat_ws("\n", F.lit("Name one category."), about, short), F.concat_ws("\n", F.lit("Give facts and counterfacts."), about, feature_text(F.col("features"), 5)), F.concat_ws("\n", F.lit("Score from 0 to 10."), about, short))
    named = ("summary", "features", "classification", "factual_pairs", "score")
    tasks = lambda short: F.array(*[F.when(w, F.struct(F.lit(k).alias("task"), t.alias("prompt"))) for k, w, t in zip(named, when, texts(short), strict=True)])
    asked = packages.select("name", F.explode(F.filter(bound(short, tasks), lambda x: x.isNotNull())).alias("x")).select("name", "x.*")
    return asked.withColumn("tokens", estimate_tokens(F.col("prompt")))


def answered(asked: DataFrame, settings: Settings = Settings(), policy: str = "unified", cost_per_token: float = 0.0) -> DataFrame:
    """``asked`` with ``answer``: one provider a partition, whole Arrow batches, in order. With a cost a token, only the
    calls made before the budget is used up are answered, in order of name and task."""
    if cost_per_token > 0:
        # money is decimal: the same calls are admitted whatever the order of adding
        priced = asked.withColumn("_cost", ((F.col("tokens") + settings.max_tokens) * F.lit(f"{cost_per_token:.9f}").cast("decimal(18,9)")).cast("decimal(38,9)"))
        asked = admitted(priced, [], ["name", "task"], "_cost", F.lit(settings.budget)).drop("_cost", "spent")
    provider_of(settings)
    schema = asked.schema.simpleString()[7:-1].replace(":", " ") + ", answer string"

    def run(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        provider = provider_of(settings)
        local = settings.provider in LOCAL
        for batch in rows:
            found = [with_retries(provider.call, Request(local_prompt(p, settings.token_limit - settings.max_tokens) if local else p, max_tokens=settings.max_tokens, system=t), lambda x, t=t: _valid(t, x), RETRIES[policy]) for p, t in zip(batch["prompt"], batch["task"], strict=True)]
            yield batch.assign(answer=found)

    return asked.mapInPandas(run, schema)


def enriched(packages: DataFrame, settings: Settings = Settings(), gating: str = "local", formula_score: bool = True) -> DataFrame:
    """Packages with the enrichment columns; a package whose calls fail keeps its row with nulls."""
    done = answered(prompts(packages, settings, gating), settings, cost_per_token=settings.cost_per_token)
    pick = lambda task: F.max(F.when(F.col("task") == task, F.col("answer")))
    wide = done.groupBy("name").agg(pick("summary").alias("_s"), pick("features").alias("_f"), pick("classification").alias("_c"), pick("factual_pairs").alias("_p"), pick("score").alias("_n"))
    joined = packages.drop("readme_summary", "feature_summary", "use_case", "factual_counterfactual", "score").join(wide, "name", "left")
    own = popularity(F.col("downloads"), F.col("github_stars"), F.char_length("readme")) if formula_score else F.when(F.col("_n").isNotNull(), answers.score_of(F.col("_n")))
    return joined.select("*", answers.general_answer(F.col("_s")).alias("readme_summary"), answers.general_answer(F.col("_f")).alias("feature_summary"), F.when(F.col("_c").isNotNull(), answers.category_of(F.col("_c"))).alias("use_case"), answers.fact_pairs(F.col("_p")).alias("factual_counterfactual"), own.alias("score")).drop("_s", "_f", "_c", "_p", "_n")


def context(turns: DataFrame, keys: list[str], order: str, text: str, last: int, separator: str = "\n", max_tokens: int | None = None) -> DataFrame:
    """With ``context``: the text of the ``last`` turns before each, oldest first, smartly cut to ``max_tokens``."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(-last, -1)
    joined = F.array_join(F.collect_list(text).over(w), separator)
    return turns.withColumn("context", joined if max_tokens is None else smart_truncate(joined, max_tokens))


def context_within(turns: DataFrame, keys: list[str], order: str, text: str, budget: int, last: int = 5, least: int = 100) -> DataFrame:
    """With ``context``: of the ``last`` turns, from the newest backwards, those that fit ``budget`` less the turn's own
    tokens; one more is cut to the rest if over ``least`` tokens are left. Parts are set apart by ``---``."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(-last, -1)
    start = F.struct(F.array().cast("array<string>").alias("out"), (F.lit(budget) - estimate_tokens(F.col(text))).cast("bigint").alias("room"), F.lit(False).alias("done"))

    def step(a: Column, t: Column) -> Column:
        n = estimate_tokens(t)
        fits = F.struct(F.concat(F.array(t), a["out"]).alias("out"), (a["room"] - n).alias("room"), a["done"].alias("done"))
        part = F.struct(F.concat(F.array(F.substring(t, F.lit(1), (a["room"] * 4).cast("int"))), a["out"]).alias("out"), F.lit(0).cast("bigint").alias("room"), F.lit(True).alias("done"))
        end = F.struct(a["out"].alias("out"), a["room"].alias("room"), F.lit(True).alias("done"))
        return F.when(a["done"], a).when(n <= a["room"], fits).when(a["room"] > least, part).otherwise(end)

    turned = F.reverse(F.collect_list(text).over(w))
    return turns.withColumn("_turns", turned).withColumn("context", F.aggregate("_turns", start, step, lambda a: F.array_join(a["out"], "\n---\n"))).drop("_turns")
