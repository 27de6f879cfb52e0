"""Proposals of an outside writer, who asks for data through the SQL gate and whose figures are checked before anything is kept.

The writer is a function (messages) -> reply text with its number of tokens in and out; nothing here knows a vendor. A reply is JSON:
{"sql": "..."} asks for data, {"proposal": [{"ticker", "view", "column", "value"}, ...]} ends the talk.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ledgerline.operators import reports
from ledgerline.plans import gate


@dataclass
class Reply:
    text: str
    tokens_in: int = 0
    tokens_out: int = 0


Writer = Callable[[list[dict[str, str]]], Reply]


@dataclass
class UsageMeter:
    """Calls and tokens of a talk, and a limit beyond which no more are made."""

    most_calls: int = 40
    most_tokens: int = 400_000
    calls: int = 0
    tokens_in: int = 0
    tokens_out: int = 0

    def ask(self, writer: Writer, messages: list[dict[str, str]]) -> Reply:
        if self.calls >= self.most_calls or self.tokens_in + self.tokens_out >= self.most_tokens:
            raise RuntimeError(f"usage limit reached after {self.calls} calls")
        reply = writer(messages)
        self.calls += 1
        self.tokens_in += reply.tokens_in
        self.tokens_out += reply.tokens_out
        return reply

    def text(self) -> str:
        return f"{self.calls} calls, {self.tokens_in} tokens in, {self.tokens_out} tokens out"


@dataclass
class Case:
    """What a talk led to. checks: (check, passed, detail)."""

    task: str
    proposal: list[dict] = field(default_factory=list)
    checks: list[tuple[str, bool, str]] = field(default_factory=list)
    queries: list[tuple[str, str]] = field(default_factory=list)
    review: str = ""
    error: str = ""

    @property
    def passed(self) -> bool:
        return not self.error and bool(self.proposal) and all(ok for _, ok, _ in self.checks)


def _parsed(text: str) -> dict:
    """The JSON object of a reply, which may stand among other words."""
    a, b = text.find("{"), text.rfind("}")
    try:
        found = json.loads(text[a : b + 1]) if a >= 0 else {}
    except ValueError:
        return {}
    return found if isinstance(found, dict) else {}


def cited(spark: SparkSession, proposal: list[dict]) -> DataFrame:
    rows = [tuple(None if p.get(k) is None else str(p[k]) for k in ("ticker", "view", "column", "value")) for p in proposal]
    return spark.createDataFrame(rows, "ticker string, view string, column string, value string")


def verified(spark: SparkSession, proposal: list[dict], views: dict[str, DataFrame], **limits) -> list[tuple[str, bool, str]]:
    return [tuple(r) for r in gate.verify_proposal(cited(spark, proposal), views, **limits).collect()]


def screen(spark: SparkSession, task: str, views: dict[str, DataFrame], writer: Writer, reviewer: Writer | None = None, turns: int = 12, meter: UsageMeter | None = None) -> Case:
    """A talk of at most `turns` replies: data through the gate, then a proposal, its checks, and one correction if a check or the reviewer objects. A reviewer that fails doesn't stop the case."""
    meter, case = meter or UsageMeter(), Case(task)
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    messages = [{"role": "system", "content": f"Answer with one JSON object: {{\"sql\": ...}} or {{\"proposal\": [...]}}.\n{gate.schema_context(views)}"}, {"role": "user", "content": task}]
    corrected = False
    for _ in range(turns):
        try:
            reply = meter.ask(writer, messages)
        except Exception as e:  # the case keeps what was found so far  # noqa: BLE001
            case.error = f"{type(e).__name__}: {e}"
            return case
        messages.append({"role": "assistant", "content": reply.text})
        said = _parsed(reply.text)
        if "sql" in said:
            answer = gate.run_sql(spark, str(said["sql"]), views=set(views))
            case.queries.append((str(said["sql"]), answer))
        elif isinstance(said.get("proposal"), list) and all(isinstance(p, dict) for p in said["proposal"]):
            case.proposal = said["proposal"]
            case.checks = verified(spark, case.proposal, views)
            objections = [f"{check}: {detail}" for check, ok, detail in case.checks if not ok]
            case.review = _review(reviewer, meter, case) if reviewer else ""
            if corrected or not (objections or case.review):
                return case
            corrected, answer = True, "Correct this once: " + "; ".join([*objections, *([case.review] if case.review else [])])
        else:
            answer = "That was no JSON object with sql or proposal."
        messages.append({"role": "user", "content": answer})
    if not case.proposal:
        case.error = f"no proposal after {turns} replies"
    return case


def _review(reviewer: Writer, meter: UsageMeter, case: Case) -> str:
    """The reviewer's objection, '' if there is none or the review fails."""
    try:
        said = _parsed(meter.ask(reviewer, [{"role": "user", "content": json.dumps({"task": case.task, "proposal": case.proposal, "checks": case.checks})}]).text)
    except Exception:  # a review is a help, not a condition  # noqa: BLE001
        return ""
    return "" if said.get("ok", True) else str(said.get("objection", "objected"))


def case_text(spark: SparkSession, case: Case, meter: UsageMeter | None = None) -> str:
    """A case as markdown."""
    parts = [f"# {case.task}", f"Outcome: {'passed' if case.passed else case.error or 'not passed'}"]
    if case.proposal:
        parts += ["## Proposal", reports.table(cited(spark, case.proposal))]
    if case.checks:
        parts += ["## Checks", reports.table(spark.createDataFrame(case.checks, "check string, passed boolean, detail string"))]
    if case.review:
        parts += ["## Review", case.review]
    for sql, answer in case.queries:
        parts += ["## Query", f"```sql\n{sql}\n```", f"```\n{answer}\n```"]
    return "\n\n".join([*parts, *([meter.text()] if meter else []), reports.CAVEATS]) + "\n"
