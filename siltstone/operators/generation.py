"""Model calls as row functions, with retries, validation feedback and a replay of recorded answers.

A generator has generate(prompt, system) -> str and is pickled to the executors; each partition uses its own copy. Spark may run a
task twice, so that paid calls belong behind a Replay of what has been recorded.
"""

from __future__ import annotations

import hashlib
import json
import os
import random
import re
import time
import urllib.error
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.responses import entity_list, extract

ANSWER = "raw_text string, parsed string, model string, duration_ms long, success boolean, error string, rounds int"
JSON_ONLY = "Answer with JSON only: no prose, no code fences."


class PromptTooLarge(ValueError):
    """A prompt with its system text above PROMPT_CHARS."""


def check_size(prompt: str, system: str = "", most: int = K.PROMPT_CHARS) -> None:
    if len(prompt) + len(system) > most:
        raise PromptTooLarge(f"prompt of {len(prompt) + len(system)} characters; at most {most}")


def load_prompt(text: str) -> str:
    """A prompt that asks for JSON, whether it did before or not."""
    return text if text.lstrip().startswith(JSON_ONLY) else f"{JSON_ONLY}\n\n{text}"


def prompt_key(prompt: Column, system: str) -> Column:
    return F.sha2(F.concat(F.lit(system), F.lit("\x00"), prompt), 256)


@dataclass
class RuleGenerator:
    """A stand-in without a model: one entity from a prompt's last paragraphs. Not a model's answer, and not to be taken for one."""

    model: str = "rule"

    def generate(self, prompt: str, system: str = "") -> str:
        text = prompt.split("\n\n", 1)[-1].strip()
        name = re.split(r"(?<=[.!?])\s", text, maxsplit=1)[0][:60].strip()
        digits = any(c.isdigit() for c in text)
        return json.dumps([{"entity_type": "metric" if digits else "product_theory", "name": name, "description": text[:400], "domain": ["general"], "relationships": [], "confidence_scores": {"classification": 0.5}}])


@dataclass
class ReplayGenerator:
    """Recorded answers by prompt_key; a prompt without one fails."""

    answers: dict[str, str]
    model: str = "replay"

    def generate(self, prompt: str, system: str = "") -> str:
        key = hashlib.sha256(f"{system}\x00{prompt}".encode()).hexdigest()
        if key not in self.answers:
            raise RuntimeError("no recorded answer")
        return self.answers[key]


@dataclass
class HttpGenerator:
    """A chat-completion endpoint; the key comes from the environment variable named key_variable, on each executor."""

    endpoint: str
    model: str
    key_variable: str = "MODEL_API_KEY"
    timeout: float = 120
    temperature: float = 0.1
    max_tokens: int = 4096
    open_url: Callable = urllib.request.urlopen

    def __post_init__(self) -> None:
        if not self.endpoint or not self.model or self.max_tokens <= 0:
            raise ValueError("endpoint, model and a positive max_tokens are needed")

    def generate(self, prompt: str, system: str = "") -> str:
        messages = [{"role": "system", "content": system}] * bool(system) + [{"role": "user", "content": prompt}]
        body = {"model": self.model, "messages": messages, "temperature": self.temperature, "max_tokens": self.max_tokens}
        head = {"Content-Type": "application/json", "Authorization": f"Bearer {os.environ.get(self.key_variable, '')}"}
        with self.open_url(urllib.request.Request(self.endpoint, json.dumps(body).encode(), head), timeout=self.timeout) as answer:
            value = json.loads(answer.read())
        try:
            content = value["choices"][0]["message"]["content"]
        except (KeyError, IndexError, TypeError) as e:
            raise ValueError("the answer has no content") from e
        if not content or not content.strip():
            raise ValueError("the answer is empty")
        return content


@dataclass
class Attempt:
    raw: str | None
    value: object
    error: str | None
    passes: list[bool] = field(default_factory=list)


def call(generator, prompt: str, system: str = "", tries: int = K.TRIES, delay: float = K.DELAY_S, sleep=time.sleep) -> Attempt:
    """An answer that holds JSON, from at most tries calls; waits between them double and vary by half."""
    check_size(prompt, system)
    error = None
    for n in range(tries):
        if n:
            sleep(delay * 2 ** (n - 1) * random.uniform(0.5, 1.5))
        try:
            raw = generator.generate(prompt, system)
        except (RuntimeError, ValueError, OSError, urllib.error.URLError) as e:
            error = f"{type(e).__name__}: {e}"
            continue
        value = extract(raw)
        if value is not None:
            return Attempt(raw, value, None)
        error = "no JSON in the answer"
    return Attempt(None, None, error)


def feedback(prompt: str, faults: list[tuple[dict, list[str]]]) -> str:
    """The prompt again, with the entities that failed, what is wrong with each, and the valid types."""
    lines = [f"- {e.get('name', '?')}: {code}" for e, codes in faults for code in codes]
    failed = json.dumps([e for e, _ in faults], indent=2, default=str)
    return (
        f"{prompt}\n\nSome entities failed validation. Return the whole corrected list as JSON.\n\nFailed:\n{failed}\n\nFaults:\n"
        + "\n".join(lines)
        + f"\n\nentity_type is one of: {', '.join(sorted(K.ENTITY_TYPES))}"
    )


def call_validated(generator, prompt: str, system: str, faults_of, rounds: int = K.VALIDATION_RETRIES, **settings) -> tuple[Attempt, int]:
    """The first answer whose entities all pass, else the earliest with the most that pass. faults_of: entity to codes."""
    best, ask, used = None, prompt, 0
    for n in range(1 + rounds):
        try:
            a = call(generator, ask, system, **settings)
        except PromptTooLarge:
            if best is None:
                raise
            break  # the feedback has outgrown the prompt: keep the best answer so far
        used = n + 1
        if a.error:
            best = best or a
            continue
        entities = entity_list(a.value)
        codes = [faults_of(e) for e in entities]
        a.passes = [not c for c in codes]
        if best is None or best.error or sum(a.passes) > sum(best.passes):
            best = a
        if all(a.passes):
            break
        ask = feedback(prompt, [(e, c) for e, c in zip(entities, codes, strict=True) if c])
    return best, used


def extraction_faults(e: dict) -> list[str]:
    """The gravest of the extraction errors, for the retry loop; validate() judges with columns."""
    out, desc = [], e.get("description")
    desc = desc if isinstance(desc, str) else ""
    if not (isinstance(e.get("name"), str) and e["name"].strip()):
        out.append("name")
    if not (isinstance(e.get("domain"), list) and e["domain"]):
        out.append("domain")
    if len(desc) < K.DESCRIPTION_LEAST:
        out.append(f"description_length:{len(desc)}")
    elif len(re.findall(r"[.!?](?:\s|\Z)", desc)) < K.SENTENCES_LEAST:
        out.append("description_sentences")
    return out


def generate(rows: DataFrame, prompt: str, generator, system: str = "", faults_of=None, rounds: int = K.VALIDATION_RETRIES, **settings) -> DataFrame:
    """rows with answer: a struct of ANSWER. Rows fail one by one, as an error; parallelism is that of the partitions."""

    def run(batches):
        for b in batches:
            out = []
            for text in b[prompt]:
                began = time.monotonic()
                try:
                    if faults_of:
                        a, used = call_validated(generator, text or "", system, faults_of, rounds, **settings)
                    else:
                        a, used = call(generator, text or "", system, **settings), 1
                except PromptTooLarge as e:
                    a, used = Attempt(None, None, str(e)), 0
                out.append({
                    "raw_text": a.raw, "parsed": None if a.value is None else json.dumps(a.value), "model": generator.model,
                    "duration_ms": int((time.monotonic() - began) * 1000), "success": a.error is None, "error": a.error, "rounds": used,
                })
            b["answer"] = out
            yield b

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInPandas(run, f"{schema}, answer struct<{', '.join(x.replace(' ', ':', 1) for x in ANSWER.split(', '))}>")


def best_attempt(attempts: DataFrame, group: str, order: Column, all_pass: Column, passes: Column, answer: Column) -> DataFrame:
    """(group, answer): over recorded attempts, the choice that call_validated makes."""
    first_full = F.struct(all_pass.cast("int"), F.when(all_pass, -order).otherwise(0), passes, -order)
    return attempts.groupBy(group).agg(F.max_by(answer, first_full).alias("answer"))
