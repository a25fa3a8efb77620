"""Installment payments, one row per loan."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from ..functions.numeric import aggregate, duck_round, named, ratio, share

# Trailing windows, in days before the application.
WINDOWS = {"3m": 90, "6m": 180, "12m": 365}
LONG_OVERDUE_DAYS = 30


def installments_features(stg_inst: DataFrame) -> DataFrame:
    delay = "days_entry_payment - days_instalment"
    late = "days_entry_payment > days_instalment"
    return aggregate(stg_inst, ["loan_id"], {
        "inst_total_count": "count(*)",
        "inst_late_count": f"count_if({late})",
        "inst_late_ratio": share(late, 4),
        "inst_late_avg": duck_round(f"avg({delay})", 2),
        "inst_payment_ratio": duck_round(f"avg({ratio('payment_amount', 'instalment_amount')})", 4),
        "inst_late_max": f"max({delay})",
        "instpay_payment_avg": "coalesce(avg(payment_amount), 0e0)",
        "instpay_payment_sum": "coalesce(sum(payment_amount), 0e0)",
    })


def _lateness(stg_inst: DataFrame) -> DataFrame:
    """Rows with a due day, with days late (NULL when unpaid) and the paid share."""
    return stg_inst.where("days_instalment IS NOT NULL").select("loan_id", "days_instalment", *named({
        "days_late": "days_entry_payment - days_instalment",
        "paid_share": ratio("payment_amount", "instalment_amount"),
    }))


def _window_aggregates(name: str, inside: str) -> dict[str, str]:
    """Aggregates over the rows inside one window; NULL when there is none."""
    rows = f"nullif(count_if({inside}), 0)"
    return {
        f"inst_late_ratio_{name}": f"count_if({inside} AND days_late > 0) / {rows}",
        f"inst_dpd30_ratio_{name}": f"count_if({inside} AND days_late > {LONG_OVERDUE_DAYS}) / {rows}",
        f"inst_payment_ratio_{name}": f"avg(paid_share) FILTER (WHERE {inside})",
        f"inst_late_max_{name}": f"max(days_late) FILTER (WHERE {inside})",
        f"inst_count_{name}": rows,
    }


def _projected(windows: dict[str, int]) -> list[str]:
    """Output columns: the shortest window also reports its maximum and its count."""
    shortest = min(windows, key=windows.get)
    names = []
    for name in windows:
        names += [f"inst_late_ratio_{name}", f"inst_dpd30_ratio_{name}", f"inst_payment_ratio_{name}"]
        if name == shortest:
            names += [f"inst_late_max_{name}", f"inst_count_{name}"]
    return names


def _trends(windows: dict[str, int]) -> dict[str, str]:
    """Late share of the window over the all-time one, for all but the longest window."""
    longest = max(windows, key=windows.get)
    return {f"inst_late_trend_{n}_vs_all": ratio(f"inst_late_ratio_{n}", "inst_late_ratio_all")
            for n in windows if n != longest}


def installments_windowed(stg_inst: DataFrame, windows: dict[str, int] = WINDOWS) -> DataFrame:
    """All trailing windows and trends from one scan and one aggregate."""
    aggregates = {"inst_late_ratio_all": share("days_late > 0")}
    for name, days in windows.items():
        aggregates |= _window_aggregates(name, f"days_instalment >= -{days}")
    wanted = ["inst_late_ratio_all", *_projected(windows)]
    grouped = aggregate(_lateness(stg_inst), ["loan_id"], {n: aggregates[n] for n in wanted})
    return grouped.select("loan_id", *_projected(windows), *named(_trends(windows)))


def installments_windowed_joined(stg_inst: DataFrame, windows: dict[str, int] = WINDOWS) -> DataFrame:
    """The same result as one filtered aggregate per window, left-joined to the all-time one.

    Kept to check the one-pass form against; it scans the payments once per window.
    """
    rows = _lateness(stg_inst)
    overall = aggregate(rows, ["loan_id"], {"inst_late_ratio_all": share("days_late > 0")})

    def with_window(left: DataFrame, window: tuple[str, int]) -> DataFrame:
        name, days = window
        inside = rows.where(f"days_instalment >= -{days}")
        return left.join(aggregate(inside, ["loan_id"], _window_aggregates(name, "true")), "loan_id", "left")

    joined = reduce(with_window, windows.items(), overall)
    return joined.select("loan_id", *_projected(windows), *named(_trends(windows)))
