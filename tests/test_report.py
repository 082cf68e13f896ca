"""How rows travel in the report by Series, and that it doesn't change what is matched."""

import datetime
import re

from studyloom.operators import matching

DAY = datetime.date(2024, 1, 2)
FILES = "study_uid string, series_uid string, sop_uid string, frames int, acquisition_date date, study_date date, modality string, series_description string, screening string, patient_name string, patient_id string"
REGISTRY = "source_order int, name_key string, screening_key string, hospital_number string, surgery_date date"


def report(spark):
    rows = [(f"s{i % 3}", f"s{i % 3}.{i % 2}", f"i{i % 7}", 8 if i % 5 == 0 else None, DAY if i % 4 else None, DAY, "CT", "d", f"01-H00{i % 3}" if i % 6 else "", ("li", "wu", "", "xu")[i % 4], f"p{i % 3}") for i in range(60)]
    registry = [(1, "li", "01-H001", "h1", DAY), (2, "q", "01-H002", "h2", None), (3, "wu", "01-H009", "h3", DAY), (4, "wu", "01-H008", "h4", DAY)]
    return matching.series_report(spark.createDataFrame(rows, FILES), spark.createDataFrame(registry, REGISTRY))


def test_files_travel_once_and_numbers_are_sent(spark):
    plan = report(spark)._jdf.queryExecution().executedPlan().toString()
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert not [k for k in keys if "sop_uid" in k or k.startswith("_number")]
    assert len([k for k in keys if "study_uid" in k]) == 1


def test_many_numbers_give_the_same_report(spark, monkeypatch):
    rows = lambda: sorted(map(str, report(spark).collect()))
    sent = rows()
    monkeypatch.setattr(matching, "SENT_NUMBERS", 0)
    assert rows() == sent and len(sent) > 10 and {r.match for r in report(spark).collect()} >= {"name", "screening_number", "ambiguous_name"}


def test_the_report_of_exceptions_carries_only_what_it_needs(spark):
    plan = matching.report_exceptions(report(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert "series_description" not in plan.split("LogicalRDD")[0]
