"""Every registered query runs, and equals its SQL where it has one."""
from __future__ import annotations

import math
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from gaugeworks.plans.catalog import QUERIES as READINGS
from tests.conftest import SF_DIR

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    return repr(value + 0.0) if isinstance(value, float) else str(value)


def _canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted("|".join(_cell(row[i]) for i in order) for row in rows)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


# K-means on unplanted stations: compared with brute force in test_cluster.
WITHOUT_SQL = {"m4_k_table", "m5_natural_choice"}


def test_every_query_has_sql():
    assert set(READINGS) - WITHOUT_SQL <= set(ORACLES) <= set(QUERIES)
    assert len(READINGS) > 130


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    cursor = duck.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert _canonical(df.columns, df.collect()) == _canonical(columns, cursor.fetchall())


@pytest.mark.parametrize("lacking", ["corpus_pipeline", "regex", "gaugeworks.llm"])
def test_readings_stay_registered_whatever_the_text_part_lacks(lacking):
    code = f"import sys, warnings; warnings.simplefilter('ignore'); sys.modules['{lacking}'] = None\n" \
           "import __spark_entry__ as e; from gaugeworks.plans.catalog import QUERIES\n" \
           "assert e.queries() == QUERIES and len(QUERIES) > 150"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(entry.__file__).parent)
