"""Model-assisted labels: prompts, a pluggable scorer, tolerant JSON extraction and clipping."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.fields import clip01, ensure_id
from plumbline.functions.schema import SCORES, SILVER, require
from plumbline.operators.joins import fuse_with_rules
from plumbline.operators.sampling import random_sample
from plumbline.sources import io
from plumbline.sources.scratch import materialize

#: What a model is asked for; a deployment passes its own prompt and examples.
SYSTEM = "Rate the review of a place. Answer with one JSON object, numbers between 0 and 1, with the keys " + ", ".join(SCORES) + ". No other text."


class Scorer(Protocol):
    """A model: answers one list of chat messages with text. Made once a Python worker."""

    def __call__(self, messages: list[dict]) -> str: ...


def messages(df: DataFrame, system: str = SYSTEM, shots: list[dict] | None = None, text: str = "text", rating: str = "rating", place: str = "name", category: str = "category") -> Column:
    """array<struct<role, content>>: the system text, the examples, then the context there is and the review."""
    fixed = [{"role": "system", "content": system.strip()}]
    for shot in shots or []:
        fixed += [{"role": "user", "content": json.dumps(shot.get("input", {}), ensure_ascii=False)}, {"role": "assistant", "content": json.dumps(shot.get("output", {}))}]
    said = lambda role, content: F.struct(role.alias("role"), content.alias("content"))
    context = []
    for title, c in (("Place", place), ("Category", category)):
        if c in df.columns:
            value = F.array_join(F.col(c), ", ") if isinstance(df.schema[c].dataType, T.ArrayType) else F.col(c).cast("string")
            context.append(F.when(F.coalesce(value, F.lit("")) != "", F.concat(F.lit(f"{title}: "), value)))
    if rating in df.columns:
        context.append(F.concat(F.lit("Rating: "), F.col(rating).try_cast("int").cast("string")))
    review = F.concat(F.lit("Review:\n"), F.trim(F.coalesce(F.col(text).cast("string"), F.lit(""))))
    return F.array(*[said(F.lit(m["role"]), F.lit(m["content"])) for m in fixed], said(F.lit("user"), F.concat_ws("\n", *context, review)))


def first_object(text: str | None) -> str | None:
    """The first complete JSON object in a model's answer, as JSON text.

    Fence marks and role names are dropped, other prose is passed over;
    trailing commas and single quotes are mended.
    """
    text = re.sub(r"(?i)\b(assistant|user)\s*:\s*", "", re.sub(r"```(?:json)?", "", text or ""))
    begin = text.find("{")
    if begin < 0:
        return None
    open_, quoted = 0, False
    for m in re.finditer(r'\\.|["{}]', text[begin:], re.S):
        mark = m[0]
        if mark == '"':
            quoted = not quoted
        elif not quoted and mark in "{}":
            open_ += 1 if mark == "{" else -1
            if not open_:
                body = text[begin : begin + m.end()]
                for attempt in (body, re.sub(r",\s*([}\]])", r"\1", body).replace("'", '"')):
                    try:
                        found = json.loads(attempt)
                    except ValueError:
                        continue
                    return json.dumps(found)
                return None
    return None


def _extractor():
    @F.pandas_udf("string")
    def extract(answers: pd.Series) -> pd.Series:
        return answers.map(first_object)

    return extract


def extract_json(answer: Column) -> Column:
    """The first JSON object of an answer, or null; brackets that nest need a scan that patterns can't do."""
    return _extractor()(answer)


def heuristic(chat: list[dict]) -> str:
    """A stand-in for a model: keyword scores for the last message."""
    review = chat[-1]["content"].rpartition("Review:\n")[2]
    words = re.findall(r"\w+", review.lower())
    share = lambda *known: round(min(1.0, 10 * sum(w in known for w in words) / max(1, len(words))), 3)
    spam = 1.0 if len(words) < 3 else round(1 - len(set(words)) / len(words), 3)
    ads = share("promo", "discount", "code", "free", "offer", "http", "www")
    rant = 1.0 if re.search(r"never been|i heard|would not go", review, re.I) else 0.0
    return json.dumps({"ads_promo": ads, "irrelevant": share("iphone", "android", "laptop"), "rant_no_visit": rant, "spam_low_quality": spam, "relevancy_score": round(1 - max(ads, spam), 3), "visit_likelihood": 1 - rant})


def local_model(path: str, device: str | None = None, new_tokens: int = 200, trust_remote_code: bool = False):
    """A make() for a causal language model in a folder (or by name) that every worker can read: loaded once a worker, greedy answers."""

    def make() -> Scorer:
        import torch
        from transformers import AutoModelForCausalLM, AutoTokenizer

        where = device or ("cuda" if torch.cuda.is_available() else "cpu")
        tokens = AutoTokenizer.from_pretrained(path, trust_remote_code=trust_remote_code)
        model = AutoModelForCausalLM.from_pretrained(path, trust_remote_code=trust_remote_code, torch_dtype=torch.float32 if where == "cpu" else torch.float16).to(where).eval()

        def answer(chat: list[dict]) -> str:
            asked = tokens.apply_chat_template(chat, add_generation_prompt=True, return_tensors="pt").to(where)
            with torch.inference_mode():
                said = model.generate(asked, max_new_tokens=new_tokens, do_sample=False, pad_token_id=tokens.pad_token_id or tokens.eos_token_id)
            return tokens.decode(said[0, asked.shape[1] :], skip_special_tokens=True)

        return answer

    return make


def repair(chat: list[dict]) -> list[dict]:
    """What is asked after an answer without JSON: the system text, the wanted object spelled out, and the review alone."""
    review = chat[-1]["content"].rpartition("Review:\n")[2]
    wanted = json.dumps(dict.fromkeys(SCORES, 0.0))
    return [chat[0], {"role": "user", "content": f"Your answer must be this JSON object and nothing else, each number replaced by one from 0 to 1:\n{wanted}\n\nReview:\n{review}"}]


def ask(model: Scorer, chat: list[dict], retries: int = 1) -> tuple[list[dict], str, str | None]:
    """The last prompt, the answer as it came and the object in it; an answer without one is followed by the repair prompt."""
    for attempt in range(1 + retries):
        chat = repair(chat) if attempt == 1 else chat
        try:
            raw = model(chat)
            found = first_object(raw)
        except Exception as e:  # noqa: BLE001  a failed call counts as no answer
            raw, found = repr(e), None
        if found:
            break
    return chat, raw, found


def answers(df: DataFrame, make=lambda: heuristic, id_key: str = "review_id", retries: int = 1, **fields) -> DataFrame:
    """id, prompt (the last one, as JSON), answer (as it came) and json (the object in it, or null).

    An answer without JSON is followed by the repair prompt, up to `retries`
    times. make() builds the scorer once a worker, so a model is loaded once and
    rows stream through in Arrow batches.
    """
    asked = df.select(F.col(id_key).alias("__id"), messages(df, **fields).alias("__chat"))

    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make()
        for batch in batches:
            out = []
            for chat in batch["__chat"]:
                chat = [{"role": m["role"], "content": m["content"]} for m in chat]
                chat, raw, found = ask(model, chat, retries)
                out.append((json.dumps(chat, ensure_ascii=False), raw, found))
            yield pd.DataFrame({"__id": batch["__id"], **{c: [x[i] for x in out] for i, c in enumerate(("prompt", "answer", "json"))}})

    kind = asked.schema["__id"].dataType.simpleString()
    return asked.mapInPandas(answer, f"__id {kind}, prompt string, answer string, json string").withColumnRenamed("__id", id_key)


def scores_of(found: DataFrame, id_key: str = "review_id") -> DataFrame:
    """id and the six scores within 0 and 1 of answers(); all 0 where there was no object."""
    raw = F.from_json("json", ", ".join(f"{c} string" for c in SCORES))
    value = lambda c: F.when(F.col("json").isNull(), F.lit(0.0)).otherwise(clip01(F.col(f"__s.{c}")))
    return found.withColumn("__s", raw).select(id_key, *[value(c).alias(c) for c in SCORES])


def score(df: DataFrame, make=lambda: heuristic, id_key: str = "review_id", retries: int = 1, **fields) -> DataFrame:
    """id and the six scores within 0 and 1; all 0 if no answer had a JSON object."""
    return scores_of(answers(df, make, id_key, retries, **fields), id_key)


def raw_model(prefix: str = "") -> Column:
    """Canonical JSON of the six scores."""
    return F.to_json(F.struct(*[F.col(f"{prefix}{c}").alias(c) for c in SCORES]), {"ignoreNullFields": "false"})


def silver(df: DataFrame, n: int = 2000, seed: int = 16, id_key: str = "review_id", rules: DataFrame | None = None, make=lambda: heuristic, prompt: dict | None = None, debug: str | None = None, **fusion) -> DataFrame:
    """Labels for a seeded sample of n rows (0: all), fused with rule priors where rules are given.

    prompt: the system text and the examples, as messages() takes them. debug: a
    folder that gets the first prompts with their raw answers.
    """
    require(df, ["text"])
    df = ensure_id(df, id_key)
    found = answers(random_sample(df, n, seed, id_key) if n else df, make, id_key, **(prompt or {}))
    if debug:
        found = materialize(found)  # so that the model isn't asked twice
        io.debug_dump(found, debug)
    labels = scores_of(found, id_key)
    return fuse_with_rules(labels, rules, id_key=id_key, **fusion) if rules is not None else labels


def empty_silver(spark) -> DataFrame:
    return spark.createDataFrame([], SILVER)


def _unit(x) -> float | None:
    """clip01, of a value from JSON."""
    try:
        x = None if x is None or isinstance(x, bool) else float(x)
    except (TypeError, ValueError):
        return None
    return None if x is None or x != x else min(1.0, max(0.0, x))


def _scored(model: Scorer, chat, retries: int) -> tuple:
    found = ask(model, [{"role": m["role"], "content": m["content"]} for m in chat], retries)[2]
    known = json.loads(found) if found else dict.fromkeys(SCORES, 0.0)
    return tuple(_unit(known.get(c)) for c in SCORES)


def register(spark, make=lambda: heuristic, retries: int = 1) -> None:
    """SQL names: extract_json(text); review_scores(chat), a struct of the six scores; the table function score_reviews(TABLE(t)) of a table with review_id and chat.

    A chat is what messages() makes. The table function takes its table in the
    partitions it has, so nothing is shuffled for it. make() builds the scorer
    once a partition there, once a batch stream in review_scores.
    """
    spark.udf.register("extract_json", _extractor())
    kinds = ", ".join(f"{c} double" for c in SCORES)

    class ScoreReviews:
        def __init__(self):
            self.model = make()

        def eval(self, row):
            yield row["review_id"], *_scored(self.model, row["chat"], retries)

    spark.udtf.register("score_reviews", F.udtf(ScoreReviews, returnType=f"review_id string, {kinds}"))

    @F.pandas_udf(kinds)
    def review_scores(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = make()
        for chats in batches:
            yield pd.DataFrame([_scored(model, chat, retries) for chat in chats], columns=list(SCORES), dtype="float64")

    spark.udf.register("review_scores", review_scores)
