"""The sentence attached to an evaluation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kilnwatch import schemas as S

# Message templates of the alert contract.
LIMIT_TEXT = "최근 5분 내 Recipe 기준 이탈 %d회 발생. 측정값 %.3f (기준 %.3f)"
TREND_TEXT = "최근 1분 내 %s 추세 감지. 방향 비율 %.2f, 변화율 %.2f%%"
BIAS_TEXT = "최근 5분 데이터 중 %.2f%%가 공정 중심값에서 한쪽으로 편향됨"
RECOVERY_TEXT = "정상 범위 복구 (%s)"
RISING, FALLING = "증가", "감소"


def reason() -> Column:
    """Built from ``rule_name``, ``severity``, the measured figures and ``evidence``.

    ``evidence`` is the breach count of the limit rule and the share of steps in the
    trend direction of the trend rule.
    """
    rule = F.col("rule_name")
    direction = F.when(F.col("anomaly_type") == S.TREND_UP, F.lit(RISING)).otherwise(
        F.lit(FALLING)
    )
    return (
        F.when(F.col("severity") == S.NORMAL, F.format_string(RECOVERY_TEXT, rule))
        .when(
            rule == S.RULE_1,
            F.format_string(
                LIMIT_TEXT,
                F.col("evidence").cast("int"),
                F.col("measured_value"),
                F.col("reference_value"),
            ),
        )
        .when(
            rule == S.RULE_3,
            F.format_string(TREND_TEXT, direction, F.col("evidence"), F.col("deviation_rate")),
        )
        .otherwise(F.format_string(BIAS_TEXT, F.col("deviation_rate")))
    )
