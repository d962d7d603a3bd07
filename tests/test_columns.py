"""The published column names, spelled out."""

from __future__ import annotations

import pytest
from conftest import customer, tx
from datetime import date

from tidecube import Options, backfill_cube, daily_cube
from tidecube.operators.dimensions import COMPANY, PAYMENT_TYPE, Dimension

# The published columns in order.
PUBLISHED = """
DateHour PaymentType CompanyId
UUHourly TxCountHourly TxVolumeHourly UUDTH TxCountDTH TxVolumeDTH
AvgAgeHourly AvgTenureByYearHourly UUMTD TxCountMTD TxVolumeMTD TxCountQTD TxVolumeQTD
TxCountSemiYTD TxVolumeSemiYTD TxCountYTD TxVolumeYTD UUYTD UUSemiYTD UUQTD
AvgAgeDTH AvgAgeMTD AvgAgeQTD AvgAgeSemiYTD AvgAgeYTD
AvgTenureByYearDTH AvgTenureByYearMTD AvgTenureByYearQTD AvgTenureByYearSemiYTD
AvgTenureByYearYTD
HourlyContributerUUThisMonthToTheQuarter HourlyContributerUUThisMonthToTheSemiYear
HourlyContributerUUThisMonthToTheYear HourlyContributerUUThisQuarterToTheSemiYear
HourlyContributerUUThisQuarterToTheYear HourlyContributerUUThisSemiYTDToTheYear
UU2YTD UU3YTD UUFeatureLaunchedTD
HourlyContributerUUThisMonthToThe2YTD HourlyContributerUUThisQuarterToThe2YTD
HourlyContributerUUThisSemiYTDToThe2YTD HourlyContributerUUThisYTDToThe2YTD
HourlyContributerUUThisMonthToThe3YTD HourlyContributerUUThisQuarterToThe3YTD
HourlyContributerUUThisSemiYTDToThe3YTD HourlyContributerUUThisYTDToThe3YTD
HourlyContributerUUThis2YTDToThe3YTD
HourlyContributerUUThisMonthToTheUUFeatureLaunchedTD
HourlyContributerUUThisQuarterToTheUUFeatureLaunchedTD
HourlyContributerUUThisSemiYTDToTheUUFeatureLaunchedTD
HourlyContributerUUThisYTDToTheUUFeatureLaunchedTD
HourlyContributerUUThis2YTDToTheUUFeatureLaunchedTD
HourlyContributerUUThis3YTDToTheUUFeatureLaunchedTD
HourlyRetainedUUThisMonthWithinTheQuarter HourlyRetainedUUThisMonthWithinTheSemiYear
HourlyRetainedUUThisMonthWithinTheYear HourlyRetainedUUThisQuarterWithinTheSemiYear
HourlyRetainedUUThisQuarterWithinTheYear HourlyRetainedUUThisSemiYearWithinTheYear
HourlyRetentionRateThisMonthWithinTheQuarter HourlyRetentionRateThisMonthWithinTheSemiYear
HourlyRetentionRateThisMonthWithinTheYear HourlyRetentionRateThisQuarterWithinTheSemiYear
HourlyRetentionRateThisQuarterWithinTheYear HourlyRetentionRateThisSemiYTDWithinTheYear
HourlyRetainUUThisMonthToThe2YTD HourlyRetainUUThisQuarterToThe2YTD
HourlyRetainUUThisSemiYTDToThe2YTD HourlyRetainUUThisYTDToThe2YTD
HourlyRetainUUThisMonthToThe3YTD HourlyRetainUUThisQuarterToThe3YTD
HourlyRetainUUThisSemiYTDToThe3YTD HourlyRetainUUThisYTDToThe3YTD
HourlyRetainUUThis2YTDToThe3YTD
HourlyRetainUUThisMonthToTheUUFeatureLaunchedTD
HourlyRetainUUThisQuarterToTheUUFeatureLaunchedTD
HourlyRetainUUThisSemiYTDToTheUUFeatureLaunchedTD
HourlyRetainUUThisYTDToTheUUFeatureLaunchedTD
HourlyRetainUUThis2YTDToTheUUFeatureLaunchedTD
HourlyRetainUUThis3YTDToTheUUFeatureLaunchedTD
HourlyRetentionRateThisMonthToThe2YTD HourlyRetentionRateThisQuarterToThe2YTD
HourlyRetentionRateThisSemiYTDToThe2YTD HourlyRetentionRateThisYTDToThe2YTD
HourlyRetentionRateThisMonthToThe3YTD HourlyRetentionRateThisQuarterToThe3YTD
HourlyRetentionRateThisSemiYTDToThe3YTD HourlyRetentionRateThisYTDToThe3YTD
HourlyRetentionRateThis2YTDToThe3YTD
HourlyRetentionRateThisMonthToTheUUFeatureLaunchedTD
HourlyRetentionRateThisQuarterToTheUUFeatureLaunchedTD
HourlyRetentionRateThisSemiYTDToTheUUFeatureLaunchedTD
HourlyRetentionRateThisYTDToTheUUFeatureLaunchedTD
HourlyRetentionRateThis2YTDToTheUUFeatureLaunchedTD
HourlyRetentionRateThis3YTDToTheUUFeatureLaunchedTD
""".split()


def test_published_columns_and_types(make_inputs):
    inputs = make_inputs([tx(1, 1, 10, "2021-03-04 05:06:07", 1)], [(1, 2)], [customer(1)])
    cube = daily_cube(inputs, date(2021, 3, 5), date(2020, 1, 20))
    assert len(PUBLISHED) == 99
    assert cube.columns == PUBLISHED
    types = dict(cube.dtypes)
    assert types["DateHour"] == "timestamp_ntz"
    assert types["PaymentType"] == types["CompanyId"] == "int"
    assert {types[c] for c in PUBLISHED if "Volume" in c} == {"decimal(38,2)"}
    assert {types[c] for c in PUBLISHED if "Avg" in c or "Rate" in c} == {"double"}
    rest = [c for c in PUBLISHED[3:] if not any(w in c for w in ("Volume", "Avg", "Rate"))]
    assert {types[c] for c in rest} == {"bigint"}
    backfilled = backfill_cube(inputs, date(2021, 3, 4), date(2021, 3, 4), date(2020, 1, 20))
    assert backfilled.dtypes == cube.dtypes


def test_options_are_checked():
    for bad in (
        dict(dth_average="week"),
        dict(retained_2ytd="maybe"),
        dict(dimensions=(PAYMENT_TYPE, Dimension("Other"))),
        dict(dimensions=(COMPANY,)),
    ):
        with pytest.raises(ValueError):
            Options(**bad)
