import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gridlake.session import local_session  # noqa: E402

# Wide file of our own: two zones with all metrics and one with two of them, four hours of invented values.
ZONE_METRICS = {
    "PL": ["load_actual_entsoe_transparency", "wind_generation_actual", "solar_generation_actual", "price_day_ahead"],
    "DK_1": ["price_day_ahead", "solar_generation_actual", "wind_generation_actual", "load_actual_entsoe_transparency"],
    "BE": ["price_day_ahead", "load_actual_entsoe_transparency"],
}
WIDE_HEADER = ["utc_timestamp", *[f"{z}_{m}" for z, ms in ZONE_METRICS.items() for m in ms]]
WIDE_HOURS = 4


def wide_rows():
    """Hour h, column c: c.h5 (column 3 in hour 2 is 3.25)."""
    return [[f"2021-07-09T{h + 10}:00:00Z", *[f"{c}.{h}5" for c in range(1, len(WIDE_HEADER))]] for h in range(WIDE_HOURS)]


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, app="gridlake-tests", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture()
def wide_csv(tmp_path):
    path = tmp_path / "wide.csv"
    lines = [",".join(WIDE_HEADER)] + [",".join(r) for r in wide_rows()]
    path.write_text("\n".join(lines) + "\n")
    return str(path)


@pytest.fixture(scope="session")
def write_csv():
    def write(folder, name, header, rows):
        path = folder / name
        path.write_text("\n".join([",".join(header)] + [",".join(r) for r in rows]) + "\n")
        return str(path)
    return write
