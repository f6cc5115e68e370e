"""Settings of models and executors, read on the driver; nothing here touches data."""

from __future__ import annotations

import json
import os
import time
import urllib.error
import urllib.request
from collections.abc import Callable

STAGES = ("rewrite", "quality", "score", "reconcile")
EXECUTORS = ("model", "command", "local", "off")


def load(path: str, default: dict | None = None) -> dict:
    """A YAML (where PyYAML is installed) or JSON mapping; anything missing or broken gives the default."""
    try:
        with open(path, encoding="utf-8") as f:
            text = f.read()
        try:
            import yaml

            found = yaml.safe_load(text)
        except ImportError:
            found = json.loads(text)
    except Exception:  # noqa: BLE001  settings never stop a run
        return dict(default or {})
    return found if isinstance(found, dict) else dict(default or {})


def executor_entry(stage: str, kind: str, model: str = "") -> dict:
    if stage not in STAGES or kind not in EXECUTORS:
        raise ValueError(f"unknown stage or executor: {stage}, {kind}")
    return {"stage": stage, "type": kind} | ({"model": model} if model else {})


def save_executors(path: str, entries: list[dict]) -> None:
    from notewarden.sources.files import write_text

    checked = [executor_entry(e["stage"], e["type"], e.get("model", "")) for e in entries]
    write_text(path, json.dumps({"executors": checked}, ensure_ascii=False, indent=2) + "\n")


def model_for(stage: str, environ: dict | None = None, executors: dict | None = None, models: dict | None = None, default: str = "") -> str:
    """The model of a stage: from the environment, the executors, the models, or the default, in this order."""
    env = os.environ if environ is None else environ
    own = next((e.get("model") for e in (executors or {}).get("executors", []) if e.get("stage") == stage), None)
    return env.get(f"NOTEWARDEN_{stage.upper()}_MODEL") or own or (models or {}).get(stage) or default


def caller_from(environ: dict | None = None, stage: str = "rewrite", settings: dict | None = None) -> Callable[[str], str] | None:
    """A caller for the endpoint that NOTEWARDEN_URL and NOTEWARDEN_KEY name; None where there is none."""
    env = os.environ if environ is None else environ
    own = settings or {}
    url = env.get("NOTEWARDEN_URL") or own.get("url")
    model = model_for(stage, env, own, own.get("models"), own.get("model", ""))
    return http_caller(url, env.get("NOTEWARDEN_KEY", ""), model) if url else None


def http_caller(url: str, key: str, model: str, timeout: float = 180, retries: int = 2, pause: float = 1.0, open_url: Callable = urllib.request.urlopen) -> Callable[[str], str]:
    """A callable prompt -> reply for a chat endpoint; time-outs, 5xx, 429 and broken replies are tried again, other errors are not."""

    def call(prompt: str) -> str:
        body = json.dumps({"model": model, "messages": [{"role": "user", "content": prompt}]}).encode()
        request = urllib.request.Request(url, body, {"Content-Type": "application/json", "Authorization": f"Bearer {key}"})
        for attempt in range(retries + 1):
            try:
                with open_url(request, timeout=timeout) as reply:
                    return json.loads(reply.read())["choices"][0]["message"]["content"]
            except urllib.error.HTTPError as e:
                if e.code != 429 and e.code < 500 or attempt == retries:
                    raise
            except (OSError, ValueError, KeyError, IndexError):
                if attempt == retries:
                    raise
            time.sleep(pause * (attempt + 1))
        raise AssertionError

    return call
