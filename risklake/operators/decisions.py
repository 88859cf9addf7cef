"""From verdicts to approve / review / decline."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from risklake.config import AGENTS, DecisionConfig, ScoringConfig
from risklake.functions.scalars import fixed, risk_bucket, stable_id
from risklake.operators import scoring
from risklake.operators.quality import only_verdicts

FIELDS = ("agent_type", "risk_score", "reasoning", "latency_ms")


def verdict_print() -> Column:
    """A hash of a verdict's content."""
    return F.xxhash64(*FIELDS)


def collect_verdicts(verdicts: DataFrame, arrival: str, expected: int = len(AGENTS)) -> DataFrame:
    """One row per transaction that has verdicts of ``expected`` different agents.

    Of an agent that spoke several times the verdict that arrived first counts; at one
    instant the riskier one, then a hash of the verdict decides. One shuffle: copies merge before it, and a
    transaction never holds more than one verdict per agent.
    """
    body = F.struct(*FIELDS)
    riskier = F.coalesce(-F.col("risk_score"), F.lit(float("inf")))
    first = F.struct(arrival, riskier, verdict_print())
    by_agent = [
        F.min_by(body, F.when(F.col("agent_type") == agent, first)).alias(agent) for agent in AGENTS
    ]
    grouped = only_verdicts(verdicts).groupBy("transaction_id").agg(*by_agent)
    return grouped.select(
        "transaction_id", F.array_compact(F.array(*AGENTS)).alias("verdicts")
    ).filter(F.size("verdicts") >= expected)


def _weight(agent: Column, cfg: DecisionConfig) -> Column:
    chosen = F.lit(float(cfg.default_weight))
    for name, weight in reversed(list(cfg.weights.items())):
        chosen = F.when(agent == name, F.lit(float(weight))).otherwise(chosen)
    return chosen


def _total(verdicts: Column, value) -> Column:
    return F.aggregate(verdicts, F.lit(0.0), lambda acc, v: acc + value(v))


def final_score(verdicts: Column, cfg: DecisionConfig = DecisionConfig()) -> Column:
    weighted = _total(verdicts, lambda v: v["risk_score"] * _weight(v["agent_type"], cfg))
    weights = _total(verdicts, lambda v: _weight(v["agent_type"], cfg))
    mean = F.when(weights > 0, weighted / weights).otherwise(0.0)
    return F.round(F.least(mean, F.lit(1.0)), 4)


def action(score: Column, cfg: DecisionConfig = DecisionConfig()) -> Column:
    return (
        F.when(score >= cfg.decline_at, "decline")
        .when((score >= cfg.review_from) & (score < cfg.decline_at), "review")
        .otherwise("approve")
    )


def decision_level(score: Column, cfg: DecisionConfig = DecisionConfig()) -> Column:
    return (
        F.when(score >= cfg.critical_at, "critical")
        .when(score >= cfg.decline_at, "high")
        .when(score >= cfg.review_from, "medium")
        .otherwise("low")
    )


def mean_score(verdicts: Column) -> Column:
    return _total(verdicts, lambda v: v["risk_score"]) / F.size(verdicts)


def needs_explanation(verdicts: Column, cfg: DecisionConfig = DecisionConfig()) -> Column:
    """Is the plain mean in the review band?"""
    mean = mean_score(verdicts)
    return (mean >= cfg.review_from) & (mean < cfg.decline_at)


def _conclude(
    df: DataFrame, mean: Column, latency: Column, listed: Column, cfg: DecisionConfig, explanation: str | None
) -> DataFrame:
    """Decision columns for rows that have ``final_risk_score``."""
    score = F.col("final_risk_score")
    parts = [
        F.concat(F.lit("Agent scores — "), listed),
        F.concat(F.lit("Weighted score: "), fixed(score, 4), F.lit(" → action: "), action(score, cfg)),
    ]
    if explanation:
        said = F.nullif(F.col(explanation), F.lit(""))
        parts.append(F.concat(F.lit("LLM analysis: "), said))
    return df.withColumns(
        {
            # The same transaction always gets the same id, so a repeated run replaces.
            "decision_id": stable_id(F.lit("decision"), F.col("transaction_id")),
            "action": action(score, cfg),
            "risk_level": decision_level(score, cfg),
            "needs_explanation": (mean >= cfg.review_from) & (mean < cfg.decline_at),
            "total_latency_ms": latency,
            "reasoning": F.concat_ws(" | ", *parts),
        }
    )


def decide(
    collected: DataFrame, cfg: DecisionConfig = DecisionConfig(), explanation: str | None = None
) -> DataFrame:
    """Decisions for rows with ``transaction_id`` and a ``verdicts`` array.

    Purely column expressions, so it joins the stage of whatever built the array. Other
    columns pass through. ``explanation`` names a text column to append to the reasoning.
    """
    verdicts = F.col("verdicts")
    listed = F.array_join(
        F.transform(verdicts, lambda v: F.concat(v["agent_type"], F.lit(": "), fixed(v["risk_score"], 3))),
        ", ",
    )
    return _conclude(
        collected.withColumn("final_risk_score", final_score(verdicts, cfg)),
        mean_score(verdicts),
        _total(verdicts, lambda v: v["latency_ms"]),
        listed, cfg, explanation,
    )


def decide_enriched(
    enriched: DataFrame,
    scoring_cfg: ScoringConfig = ScoringConfig(),
    cfg: DecisionConfig = DecisionConfig(),
) -> DataFrame:
    """``decide(with_verdicts(enriched))`` for all four agents at once.

    Scores stay plain numbers up to the decision, so everything compiles into one stage,
    and a roll-up that never looks at ``verdicts`` or ``reasoning`` does not build them.
    """
    scored = scoring.with_scores(enriched, scoring_cfg)
    scores = [F.col(f"_score_{a}") for a in AGENTS]

    def add(columns: list[Column]) -> Column:
        return reduce(lambda total, c: total + c, columns, F.lit(0.0))

    weights = [float(cfg.weights.get(a, cfg.default_weight)) for a in AGENTS]
    mean = add([s * w for s, w in zip(scores, weights)]) / add([F.lit(w) for w in weights])
    given = F.array(
        *[scoring.verdict(scored, a, scoring_cfg, s) for a, s in zip(AGENTS, scores)]
    )
    listed = F.concat_ws(", ", *[F.concat(F.lit(f"{a}: "), fixed(s, 3)) for a, s in zip(AGENTS, scores)])
    return _conclude(
        scored.withColumns(
            {"final_risk_score": F.round(F.least(mean, F.lit(1.0)), 4), "verdicts": given}
        ),
        add(scores) / len(AGENTS),
        add([scoring.latency(scored)] * len(AGENTS)),
        listed, cfg, None,
    ).drop(*[f"_score_{a}" for a in AGENTS])


def explanation_requests(collected: DataFrame, cfg: DecisionConfig = DecisionConfig()) -> DataFrame:
    """JSON payload per ambiguous transaction, for whoever writes the explanation."""
    signals = F.transform(
        "verdicts",
        lambda v: F.struct(
            v["agent_type"].alias("agent"),
            F.round(v["risk_score"], 3).alias("score"),
            v["reasoning"].alias("reasoning"),
        ),
    )
    body = F.struct(
        F.struct("transaction_id").alias("transaction"),
        signals.alias("agent_signals"),
        F.round(mean_score(F.col("verdicts")), 4).alias("weighted_score"),
    )
    return collected.filter(needs_explanation(F.col("verdicts"), cfg)).select(
        "transaction_id", F.to_json(body).alias("request")
    )


def with_decision_columns(df: DataFrame) -> DataFrame:
    return df.withColumn("risk_bucket", risk_bucket(F.col("final_risk_score"))).withColumn(
        "decision_date", F.to_date("event_time")
    )


def training_records(decisions: DataFrame, features: str | None = None) -> DataFrame:
    """A first label per decision; charge-backs and reviews correct it later."""
    body = F.col(features) if features else F.lit(None).cast("string")
    return decisions.select(
        stable_id(F.lit("training"), F.col("transaction_id")).alias("record_id"),
        "transaction_id",
        F.when(F.col("action") == "decline", 1).otherwise(0).alias("label"),
        F.lit("rule_engine").alias("label_source"),
        body.alias("features"),
        F.col("event_time").alias("created_at"),
    )
