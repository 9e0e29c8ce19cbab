"""Calls to text models from partitions: a client protocol, retries, budgets, one repair turn, and a stub that needs no network.

One client works per partition, so the number of partitions of a table is the number of calls in flight to an endpoint.
"""

from __future__ import annotations

import hashlib
import json
import random
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.loose_json import items, parse

#: Statuses that pass, attempts, and waits in seconds at most: after a 429 and after anything else.
RETRY_STATUS = {408, 409, 425, 429, 500, 502, 503, 504}
ATTEMPTS = 10
RATE_WAIT, OTHER_WAIT, SHARED_WAIT = 90.0, 45.0, 30.0
FIRST_WAIT, FIRST_COOLDOWN = 1.5, 2.0
#: The least budget that halving goes down to, and the most that doubling goes up to.
LEAST_BUDGET, MOST_BUDGET = 4000, 32000
EMBED_BATCH = 16
NO_SERVER = "no server at"
REPAIR = "That was not valid JSON. Reply again with the same content as a single JSON value and nothing else."
USAGE = "stage string, role string, model string, record_id string, request_id string, prompt_tokens long, completion_tokens long, reasoning_tokens long, latency_s double, finish_reason string"


class ModelError(RuntimeError):
    """A call that failed for good; `raw_text` is a reply that couldn't be read."""

    def __init__(self, message: str, status: int | None = None, raw_text: str = ""):
        super().__init__(message)
        self.status, self.raw_text = status, raw_text


class EndpointUnavailable(ModelError):
    """A local server that isn't there."""


@dataclass(frozen=True)
class Role:
    """One endpoint and how it is asked."""

    name: str
    model: str
    base_url: str = "http://127.0.0.1:8000/v1"
    api_key_source: str = "none"
    max_concurrency: int = 4
    temperature: float = 0.7
    max_tokens: int = 2048
    timeout_s: float = 300.0
    supports_json_mode: bool = True
    enabled: bool = True
    extra_body: dict = field(default_factory=dict)

    @property
    def endpoint(self) -> str:
        return f"{self.base_url}::{self.model}"

    @property
    def is_local(self) -> bool:
        return any(h in self.base_url for h in ("127.0.0.1", "localhost", "0.0.0.0"))


class Client(Protocol):
    def post(self, role: Role, path: str, payload: dict, stage: str) -> tuple[int, dict]:
        """(status, body) of one request.  ConnectionError where nothing answers, TimeoutError where nothing comes."""


class StubClient:
    """Replies that depend on the request alone, in the shape that each stage asks for."""

    def post(self, role: Role, path: str, payload: dict, stage: str) -> tuple[int, dict]:
        if path == "embeddings":
            vector = lambda t: [b / 255 for b in hashlib.sha256(t.encode()).digest()[:8]]
            return 200, {"id": "stub", "data": [{"index": k, "embedding": vector(t)} for k, t in enumerate(payload["input"])], "usage": {"prompt_tokens": len(payload["input"])}}
        prompt = payload["messages"][-1]["content"]
        mark = hashlib.sha256(f"{role.model}|{payload['messages'][0]['content']}|{prompt}".encode()).hexdigest()
        text = json.dumps(self.reply(stage, mark, prompt))
        usage = {"prompt_tokens": len(prompt.split()), "completion_tokens": len(text.split())}
        return 200, {"id": mark[:12], "choices": [{"message": {"content": text}, "finish_reason": "stop"}], "usage": usage}

    def reply(self, stage: str, mark: str, prompt: str) -> dict:
        wanted = int(prompt.rsplit("wanted=", 1)[1].split()[0]) if "wanted=" in prompt else 1
        if stage == "families":
            return {"families": [{"seed_situation": f"situation {mark[:8]}-{k}", "why_it_is_hard": "two duties", "situation_features": {"relationship": "colleague"}, "varied_fact": f"fact {k}"} for k in range(wanted)]}
        if stage == "prompts":
            return {"prompts": [{"text": f"what should I do about {mark[k : k + 8]}", "register": "terse", "question_kind": "what_to_do"} for k in range(wanted)]}
        if stage == "reframing":
            return {"text": f"a tale of {mark[:16]}"}
        if stage in ("responses", "revise"):
            return {"deliberation": f"weighing {mark[:6]}", "answer": f"do {mark[6:12]}", "principles_applied": [], "source_passages": [], "expected_actions": f"does {mark[6:12]}"}
        if stage == "review":
            odd = int(mark[:2], 16) % 4
            flags = {f: False for f in ("cue_leakage", "confident_on_unresolved", "formulaic_shape", "prompt_stipulates_move", "quoted_source_text", "archaic_register")}
            return {"scores": {"fidelity": 5, "judgment_not_terminology": 4, "scenario_quality": 4, **flags}, "judgment_evidence_quote": "as said", "verdict": ("accept", "accept", "revise", "reject")[odd], "rationale": mark[:8]}
        if stage == "divergence":
            return {"value_named": "candour", "divergence_source": ("value", "capability")[int(mark[0], 16) % 2], "kind": "action", "explanation": mark[:8], "actions": {"a": "x", "b": "y", "c": "z"}, "closer_to": "neither"}
        return {"items": [{"id": mark[:10], "text": prompt[:40]}]}


@dataclass
class Caller:
    """A client with its retries, the cool-down that its endpoints share, and the usage of every call it made."""

    client: Client
    sleep: Callable[[float], None] = time.sleep
    clock: Callable[[], float] = time.monotonic
    chance: Callable[[], float] = random.random
    usage: list[tuple] = field(default_factory=list)
    cooling: dict[str, float] = field(default_factory=dict)

    def post(self, role: Role, path: str, payload: dict, stage: str) -> tuple[dict, float]:
        """(body, seconds) of a request, repeated while it fails with something that passes.  Waits double, with a
        jitter; after a 429 every call to the endpoint waits."""
        said = ""
        for k in range(ATTEMPTS):
            if (rest := self.cooling.get(role.endpoint, 0.0) - self.clock()) > 0:
                self.sleep(min(rest, SHARED_WAIT))
            began, busy = self.clock(), False
            try:
                status, body = self.client.post(role, path, payload, stage)
            except ConnectionError as e:
                if role.is_local:
                    raise EndpointUnavailable(f"{NO_SERVER} {role.base_url} for role '{role.name}'") from e
                said = f"no connection: {e}"
            except TimeoutError as e:
                said = f"no reply: {e}"
            else:
                if status == 200:
                    return body, self.clock() - began
                said, busy = f"HTTP {status}", status == 429
                if busy:
                    self.cooling[role.endpoint] = self.clock() + min(RATE_WAIT, FIRST_COOLDOWN * 2**k)
                if status not in RETRY_STATUS:
                    raise ModelError(f"{role.name} ({role.model}): {said}", status)
            if k < ATTEMPTS - 1:
                self.sleep(min(RATE_WAIT if busy else OTHER_WAIT, FIRST_WAIT * 2**k) * (0.6 + 0.8 * self.chance()))
        raise ModelError(f"{role.name} ({role.model}) failed {ATTEMPTS} times, last: {said}")

    def _used(self, role: Role, body: dict, seconds: float, stage: str, record: str, finish: str = "") -> None:
        u = body.get("usage") or {}
        reasoning = (u.get("completion_tokens_details") or {}).get("reasoning_tokens") or 0
        self.usage.append((stage, role.name, role.model, record, str(body.get("id", "")), int(u.get("prompt_tokens") or 0), int(u.get("completion_tokens") or 0), int(reasoning), round(seconds, 3), finish))

    def complete(self, role: Role, messages: list[dict], stage: str = "", record: str = "", temperature: float | None = None, json_mode: bool = False) -> dict:
        """text and finish_reason of a reply.

        A budget beyond the model's window, which comes back as an error body, is halved.  A reply that spent its
        budget without an answer is asked for again, once with double the budget and once with little reasoning.
        """
        budget, extra, doubled = role.max_tokens, dict(role.extra_body), False
        while True:
            payload = {"model": role.model, "messages": messages, "temperature": role.temperature if temperature is None else temperature, "max_tokens": budget, **extra}
            if json_mode and role.supports_json_mode:
                payload["response_format"] = {"type": "json_object"}
            body, seconds = self.post(role, "chat/completions", payload, stage)
            if "choices" not in body and "error" in body:
                if "maximum number of tokens" in str(body["error"]).lower() and budget > LEAST_BUDGET:
                    budget = max(LEAST_BUDGET, budget // 2)
                    continue
                raise ModelError(f"{role.name} ({role.model}) sent an error body: {str(body['error'])[:300]}")
            choice = (body.get("choices") or [{}])[0]
            text, finish = ((choice.get("message") or {}).get("content") or "").strip(), str(choice.get("finish_reason") or "")
            self._used(role, body, seconds, stage, record, finish)
            if text or finish != "length":
                return {"text": text, "finish_reason": finish}
            if not doubled and budget < MOST_BUDGET:
                budget, doubled = min(2 * budget, MOST_BUDGET), True
            elif "reasoning_effort" not in extra:
                extra["reasoning_effort"] = "low"
            else:
                raise ModelError(f"{role.name} ({role.model}) gave no answer within {budget} tokens")

    def complete_json(self, role: Role, messages: list[dict], stage: str = "", record: str = "") -> tuple[object, dict]:
        """(value, reply); where a reply doesn't parse, one more turn without temperature asks for JSON alone."""
        reply = self.complete(role, messages, stage, record, json_mode=True)
        found = parse(reply["text"])
        if found is None:
            turns = [*messages, {"role": "assistant", "content": reply["text"][:4000]}, {"role": "user", "content": REPAIR}]
            again = self.complete(role, turns, stage, record, temperature=0.0, json_mode=True)
            found = parse(again["text"])
            if found is None:
                raise ModelError(f"{role.name} ({role.model}) sent no JSON after a second request", raw_text=again["text"] or reply["text"])
            reply = again
        return found, reply

    def request_items(self, role: Role, messages: list[dict], wanted: int, keys: list[str], required: str, stage: str = "", record: str = "") -> tuple[list[dict], dict | None]:
        """(items, short): the items of a reply whose `required` field is filled; a short batch is asked for once more with
        the shape stated, and what a batch that stays short returned comes back as `short`."""
        fits = lambda x: isinstance(x, dict) and bool(str(x.get(required) or "").strip())
        reminder = f"\n\nReturn exactly {wanted} items as {{\"{keys[0]}\": [...]}}, each with a filled \"{required}\"."
        for turn in (0, 1):
            asked = messages if not turn else [*messages[:-1], {**messages[-1], "content": messages[-1]["content"] + reminder}]
            value, reply = self.complete_json(role, asked, stage, record)
            own = [x for x in items(value, *keys, fits=fits) if fits(x)]
            if len(own) >= wanted:
                return own, None
        return own, {"wanted": wanted, "got": len(own), "payload": value, "raw_text": reply["text"]}

    def embed(self, role: Role, texts: list[str], stage: str = "") -> list[list[float]]:
        """One vector per text, in their order whatever that of the reply; a blank text is sent as "empty"."""
        vectors: list[list[float]] = []
        for at in range(0, len(texts), EMBED_BATCH):
            own = [t if t and t.strip() else "empty" for t in texts[at : at + EMBED_BATCH]]
            body, seconds = self.post(role, "embeddings", {"model": role.model, "input": own}, stage)
            rows = sorted(body.get("data") or [], key=lambda r: r.get("index", 0))
            if len(rows) != len(own):
                raise ModelError(f"{len(rows)} vectors for {len(own)} texts")
            vectors += [r["embedding"] for r in rows]
            self._used(role, body, seconds, stage, f"embed_batch_{at}")
        return vectors


def strong_generic(roles: dict[str, Role], stated: dict) -> Role:
    """The generator without the specification: what the config leaves unset on `strong_generic` comes from the generator."""
    generator = roles["generator"]
    if "strong_generic" not in roles:
        return replace(generator, name="strong_generic")
    own = roles["strong_generic"]
    kept = {k: getattr(own if stated.get(k) or (k != "extra_body" and k in stated) else generator, k) for k in ("max_tokens", "temperature", "extra_body")}
    return replace(own, **kept)


def ask_all(prompts: DataFrame, role: Role, stage: str, make_client: Callable[[], Client] = StubClient, parsed: bool = True) -> DataFrame:
    """`prompts` (record_id, system, prompt) with reply (JSON text, or plain text without `parsed`), finish_reason, error,
    raw_text (of a reply that couldn't be read) and usage (array of structs).  A failed call is a row with its error."""

    def one(caller: Caller, record: str, system: str, prompt: str) -> tuple:
        caller.usage.clear()
        messages = [{"role": "system", "content": system or ""}, {"role": "user", "content": prompt or ""}]
        try:
            if parsed:
                value, reply = caller.complete_json(role, messages, stage, record)
                text = json.dumps(value, sort_keys=True, ensure_ascii=False)
            else:
                reply = caller.complete(role, messages, stage, record)
                text = reply["text"]
            return text, reply["finish_reason"], None, None
        except ModelError as e:
            return None, "error", str(e), e.raw_text or None

    return _per_row(prompts, make_client, one, "reply string, finish_reason string, error string, raw_text string")


def request_all(prompts: DataFrame, role: Role, stage: str, keys: list[str], required: str, make_client: Callable[[], Client] = StubClient) -> DataFrame:
    """`prompts` (record_id, system, prompt, wanted) with items (JSON list), short (what a batch that stayed short
    returned, for a dead-letter table), error and usage."""

    def one(caller: Caller, record: str, system: str, prompt: str, wanted: int) -> tuple:
        caller.usage.clear()
        messages = [{"role": "system", "content": system or ""}, {"role": "user", "content": prompt or ""}]
        try:
            own, short = caller.request_items(role, messages, int(wanted), keys, required, stage, record)
            return json.dumps(own, sort_keys=True, ensure_ascii=False), short and json.dumps(short, ensure_ascii=False), None
        except ModelError as e:
            return "[]", json.dumps({"raw_text": e.raw_text}), str(e)

    return _per_row(prompts, make_client, one, "items string, short string, error string")


def _per_row(prompts: DataFrame, make_client, one, made: str) -> DataFrame:
    kinds = {f.split()[0]: f.split()[1] for f in made.split(", ")}
    given = [c for c in ("record_id", "system", "prompt", "wanted") if c in prompts.columns]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        caller = Caller(make_client())
        for frame in frames:
            rows = []
            for values in zip(*(frame[c] for c in given)):
                own = one(caller, *values)
                rows.append((values[0], *own, json.dumps(caller.usage)))
            yield pd.DataFrame(rows, columns=["record_id", *kinds, "usage"])

    out = prompts.select(*given).mapInPandas(run, f"record_id string, {made}, usage string")
    names = [f.split()[0] for f in USAGE.split(", ")]
    rows = F.from_json("usage", "array<array<string>>")
    entry = lambda u: F.struct(*(F.get(u, F.lit(k)).cast(USAGE.split(", ")[k].split()[1]).alias(n) for k, n in enumerate(names)))
    return out.withColumn("usage", F.transform(rows, entry))


def ledger_of(replies: DataFrame) -> DataFrame:
    """The usage entries of replies, without a cost, which prices give."""
    return replies.select(F.explode("usage").alias("u")).select("u.*", F.lit(None).cast("double").alias("cost_usd"))


def dead_letters(replies: DataFrame) -> DataFrame:
    """(record_id, content) of the replies that were short or couldn't be read."""
    column = "short" if "short" in replies.columns else "raw_text"
    return replies.where(F.col(column).isNotNull()).select("record_id", F.col(column).alias("content"))


def embed_all(texts: DataFrame, role: Role, make_client: Callable[[], Client] = StubClient) -> DataFrame:
    """(id, vector) of `texts` (id, text)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        caller = Caller(make_client())
        for frame in frames:
            yield pd.DataFrame({"id": frame["id"], "vector": caller.embed(role, [t or "" for t in frame["text"]], "embed")})

    return texts.select("id", "text").mapInPandas(run, "id long, vector array<double>")
