from __future__ import annotations

import os
import sys

import duckdb
import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def rows_of():
    """Rows of a given table, read without Spark."""

    def read(table: str, columns: str, sf_dir: str = SMALL) -> list[tuple]:
        return duckdb.connect().execute(f"SELECT {columns} FROM '{sf_dir}/{table}.parquet'").fetchall()

    return read


@pytest.fixture(scope="session")
def smallest_reachable():
    """Smallest id that each row reaches by a symmetric matrix of links."""

    def find(near: np.ndarray, ids: list) -> list:
        label = np.array(ids)
        while True:
            new = np.array([label[row].min() for row in near])
            if (new == label).all():
                return label.tolist()
            label = new

    return find
