"""The report metrics as data.

Batch reports, ad hoc reports and the stream all read these lists, so that a
metric is defined once. Expressions are SQL text: a plan of a hundred columns is
then put together in a handful of calls to the JVM instead of a thousand.
"""

from __future__ import annotations

from typing import NamedTuple

# Report column stem → signal it is measured on (mean, largest, smallest).
MEASURED = {
    "Met1sWSpd": "MC004",
    "Met30sWSpd": "MC082",
    "Met600sWSpd": "MC083",
    "GriActivePowerTotal": "MC061",
    "GriReactivePowerTotal": "MD002",
    "CnvGenPower30s": "MC085",
    "CnvGenPower600s": "MC086",
    "MetTmp": "MC015",
    "NacTmp": "MC014",
    "TowCbtTmp": "MC091",
}


class State(NamedTuple):
    """An operating state: report stem, MC143 code, whether the turbine counts as available."""

    stem: str
    code: int
    available: bool


# The operating states, in report order.
STATES = (
    State("FaultShutdown", 40, False),
    State("Overhaul", 50, False),
    State("Maintenance", 60, True),
    State("GridShutdown", 70, True),
    State("LocalShutdown", 81, True),
    State("RemoteShutdown", 80, True),
    State("WeatherShutdown", 90, True),
    State("LimitPower", 110, True),
    State("LimitShutdown", 111, True),
    State("Standby", 100, True),
    State("NormalGeneration", 120, True),
)

# Counters of entries into a state, named like the report column.
ENTRY_COUNTERS = tuple(f"{state.stem}Times" for state in STATES) + ("InterruptionTimes",)

# Lost energy by cause, in report order; the limit cause stays out of Discrepancy.
LOSSES = (
    "FaultLossGeneration", "OverhaulLossGeneration", "MaintainLossGeneration", "GridLossGeneration",
    "LocalLossGeneration", "RemoteLossGeneration", "WeatherLossGeneration", "LimitLossGeneration",
)

# The column order of the three report tables.
SUMMARY_COLUMNS = (
    "Time", "DeviceName", "Count", "EffectWindHours",
    "Met1sWSpdAvg", "Met1sWSpdMax", "Met1sWSpdMin",
    "Met30sWSpdAvg", "Met30sWSpdMax", "Met30sWSpdMin",
    "Met600sWSpdAvg", "Met600sWSpdMax", "Met600sWSpdMin",
    "MetAirDensityAvg", "RatedPowerData", "PreTotalGenerationFirst", "GriActiveEnergyDelLast",
    "GriActiveEnergyDelTotal", "TheoreticalGeneration", "PreTotalEleConsumptionFirst",
    "GriActiveEnergyRcvLast", "GriActiveEnergyRcvSection",
    "GriActivePowerTotalAvg", "GriActivePowerTotalMax", "GriActivePowerTotalMin",
    "GriReactivePowerTotalAvg", "GriReactivePowerTotalMax", "GriReactivePowerTotalMin",
    "CnvGenPower30sAvg", "CnvGenPower30sMax", "CnvGenPower30sMin",
    "CnvGenPower600sAvg", "CnvGenPower600sMax", "CnvGenPower600sMin",
    "EquivalentHours", "FullLoadDurationDay", "GriActiveEnergyDelUnit", "GriActiveEnergyRcvUnit",
    "MetTmpAvg", "MetTmpMax", "MetTmpMin", "NacTmpAvg", "NacTmpMax", "NacTmpMin",
    "TowCbtTmpAvg", "TowCbtTmpMax", "TowCbtTmpMin",
    "YawAcwHours", "YawAcwTimes", "YawCwHours", "YawCwTimesSum", "YawHours",
    "GenReactQLimitStateDuration", "GenReactQLimitStateTimesSum",
)
AVAILABILITY_COLUMNS = (
    ("Time", "DeviceName", "Count")
    + tuple(f"{state.stem}Duration" for state in STATES)
    + ENTRY_COUNTERS
    + ("AvailableTime", "UnAvailableTime", "Availability", "InterruptionDurationCalculated",
       "MTBFDuration", "MTTRDuration")
)
EFFICIENCY_COLUMNS = ("Time", "DeviceName", "Count", "Discrepancy", "EnergyAvailability") + LOSSES

REPORT_COLUMNS = {
    "SummaryReport": SUMMARY_COLUMNS,
    "TurbineAvailabilityMetrics": AVAILABILITY_COLUMNS,
    "EfficiencyMetrics": EFFICIENCY_COLUMNS,
}
COMBINED_COLUMNS = SUMMARY_COLUMNS + AVAILABILITY_COLUMNS[3:] + EFFICIENCY_COLUMNS[3:]

FULL_WINDOW_SECONDS = 600

# Report columns that are means over the samples of a window.
AVERAGES = ("MetAirDensityAvg", *(f"{stem}Avg" for stem in MEASURED))


def totals() -> dict[str, str]:
    """Aggregate expressions by name; all combine map-side, none needs a sort.

    Names with an underscore in front are inputs of :func:`derived` only. The
    whole buffer has 97 columns; from 101 on Spark would stop compiling the stage.
    """
    result = {
        "Count": "count(MC082)",
        "_rows": "count(1)",
        "_energy_rows": "count(MC006)",
        "EffectWindHours": "sum(IsEffectWind)",
        "MetAirDensityAvg": "avg(MC093)",
        "RatedPowerData": "min(RatedPower)",
        "PreTotalGenerationFirst": "min(MC006)",
        "GriActiveEnergyDelLast": "max(MC006)",
        "PreTotalEleConsumptionFirst": "min(MC062)",
        "GriActiveEnergyRcvLast": "max(MC062)",
        "FullLoadDurationDay": _rows_where("MD001 >= RatedPower"),
        "_generation": "sum(Generation)",
        "_consumption": "sum(Consumption)",
        "YawAcwHours": _rows_where("MA022 = 1"),
        "YawAcwTimes": _rows_where("YawCcwTimes = 1"),
        "YawCwHours": _rows_where("MA021 = 1"),
        "YawCwTimesSum": "sum(YawCwTimes)",
        "GenReactQLimitStateDuration": _rows_where("MA2353 = 1"),
        "GenReactQLimitStateTimesSum": "sum(GenReactQLimitStateTimes)",
        "TheoreticalGeneration": "sum(TheoreticalGeneration)",
        "_meter_last": "max_by(MC006, time)",
        "_meter_before": "min_by(preTotalGeneration, time)",
    }
    for stem, signal in MEASURED.items():
        result |= {f"{stem}Avg": f"avg({signal})", f"{stem}Max": f"max({signal})", f"{stem}Min": f"min({signal})"}
    result |= {f"{state.stem}Duration": _rows_where(f"MC143 = {state.code}") for state in STATES}
    result |= {counter: f"sum({counter})" for counter in ENTRY_COUNTERS}
    result |= {f"_{loss}": f"sum({loss})" for loss in LOSSES}
    return result


def _rows_where(condition: str) -> str:
    return f"count(CASE WHEN {condition} THEN 1 END)"


def _ratio(top: str, bottom: str) -> str:
    """A quotient that is null where the denominator is 0."""
    return f"try_divide(CAST({top} AS DOUBLE), {bottom})"


def derived() -> dict[str, str]:
    """Expressions over the totals of a window."""
    down = " + ".join(f"{state.stem}Duration" for state in STATES if not state.available)
    up = " + ".join(f"{state.stem}Duration" for state in STATES if state.available)
    lost = " + ".join(f"_{loss}" for loss in LOSSES if loss != "LimitLossGeneration")
    made = "(_meter_last - _meter_before)"
    delivered = "(GriActiveEnergyDelLast - PreTotalGenerationFirst)"
    result = {
        "GriActiveEnergyDelTotal": delivered,
        "GriActiveEnergyRcvSection": "GriActiveEnergyRcvLast - PreTotalEleConsumptionFirst",
        "EquivalentHours": _ratio(delivered, "RatedPowerData") + " * 3600",
        "GriActiveEnergyDelUnit": "_generation / 1e4",
        "GriActiveEnergyRcvUnit": "_consumption / 1e4",
        "YawHours": "YawAcwHours + YawCwHours",
        "AvailableTime": up,
        "UnAvailableTime": down,
        "Availability": "1 - " + _ratio(down, "_rows"),
        "InterruptionDurationCalculated": f"{FULL_WINDOW_SECONDS} - _rows",
        "MTBFDuration": _ratio("_rows - FaultShutdownDuration", "FaultShutdownTimes"),
        "MTTRDuration": _ratio("FaultShutdownDuration", "FaultShutdownTimes"),
        "EnergyAvailability": _ratio(made, "TheoreticalGeneration") + " * 3600 * 100",
        "Discrepancy": f"(1 - {_ratio(made, f'({made} + ({lost}) / 3600)')}) * 100",
    }
    result |= {loss: f"_{loss} / 3600 / 10000" for loss in LOSSES}
    return result


# Rows that add up when periods or turbines merge: seconds, counts and energies.
ADDITIVE = (
    ("Count", "EffectWindHours", "FullLoadDurationDay", "EquivalentHours", "TheoreticalGeneration",
     "GriActiveEnergyDelTotal", "GriActiveEnergyRcvSection", "GriActiveEnergyDelUnit", "GriActiveEnergyRcvUnit",
     "YawAcwHours", "YawAcwTimes", "YawCwHours", "YawCwTimesSum", "YawHours", "YawHoursTotal",
     "GenReactQLimitStateDuration", "GenReactQLimitStateTimesSum",
     "AvailableTime", "UnAvailableTime", "InterruptionDurationCalculated")
    + tuple(f"{state.stem}Duration" for state in STATES) + ENTRY_COUNTERS + LOSSES
)


def additive() -> dict[str, tuple[str, tuple[str, ...]]]:
    """Aggregates that merge report rows by adding: expression by column, and the columns that it reads.

    Means weigh by ``Count``. Ratios are made anew from sums. What a row leaves out is told by what it has: the
    seconds seen by those that are missing, the energy made by its share of the
    theoretical one. Meter readings merge as the first and the last one. A mean is exact as far as the
    signal is there in the seconds that ``Count`` counts; :mod:`anemos.operators.blocks` keeps what is exact always.
    """
    result = {name: (f"sum({name})", (name,)) for name in ADDITIVE}
    for name in AVERAGES:
        counted = f"sum(CASE WHEN {name} IS NOT NULL THEN Count END)"
        result[name] = (_ratio(f"sum({name} * Count)", counted), (name, "Count"))
    for name in ("PreTotalGenerationFirst", "PreTotalEleConsumptionFirst"):
        result[name] = (f"min({name})", (name,))
    for name in ("GriActiveEnergyDelLast", "GriActiveEnergyRcvLast"):
        result[name] = (f"max({name})", (name,))
    seen = f"sum({FULL_WINDOW_SECONDS} - InterruptionDurationCalculated)"
    made = "EnergyAvailability * TheoreticalGeneration / 3600 / 100"
    lost = [loss for loss in LOSSES if loss != "LimitLossGeneration"]
    all_lost = f"sum(CASE WHEN EnergyAvailability IS NOT NULL THEN ({' + '.join(lost)}) * 10000 END)"
    expected = "sum(CASE WHEN EnergyAvailability IS NOT NULL THEN TheoreticalGeneration END)"
    shutdowns = ("FaultShutdownDuration", "FaultShutdownTimes")
    energies = ("EnergyAvailability", "TheoreticalGeneration")
    result |= {
        "Availability": (f"1 - {_ratio('sum(UnAvailableTime)', seen)}", ("UnAvailableTime", "InterruptionDurationCalculated")),
        "MTBFDuration": (_ratio(f"({seen} - sum(FaultShutdownDuration))", "sum(FaultShutdownTimes)"),
                         ("InterruptionDurationCalculated", *shutdowns)),
        "MTTRDuration": (_ratio("sum(FaultShutdownDuration)", "sum(FaultShutdownTimes)"), shutdowns),
        "EnergyAvailability": (f"{_ratio(f'sum({made})', expected)} * 3600 * 100", energies),
        "Discrepancy": (f"(1 - {_ratio(f'sum({made})', f'(sum({made}) + {all_lost})')}) * 100", (*energies, *lost)),
    }
    return result
