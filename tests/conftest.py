from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from blotter.session import build_session  # noqa: E402
from blotter.sources.schemas import INCIDENT_COLUMNS, raw_header  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app_name="blotter-tests", shuffle_partitions=4)
    yield s
    s.stop()


def incident_line(**fields) -> list[str]:
    """A 28-field incident record; unnamed positions are empty text."""
    names = [clean for _, clean in INCIDENT_COLUMNS]
    row = [""] * len(names)
    for k, v in fields.items():
        row[names.index(k)] = "" if v is None else str(v)
    return row


def csv_text(rows: list[list[str]], header: list[str]) -> str:
    def q(v: str) -> str:
        if any(ch in v for ch in ',"\n'):
            return '"' + v.replace('"', '""') + '"'
        return v
    return "\n".join(",".join(q(v) for v in r) for r in [header, *rows]) + "\n"


INCIDENT_HEADER = raw_header(INCIDENT_COLUMNS)


@pytest.fixture(scope="session")
def incident_files(tmp_path_factory):
    """Two incident 'yearly files' with the edge rows of FIXTURES.md."""
    d = tmp_path_factory.mktemp("incidents")
    f1 = [
        # noon / midnight, quoted text with comma and doubled quote before LAT
        incident_line(dr_no=1, date_rptd="01/08/2015 12:00:00 PM", date_occ="01/08/2015 12:00:00 AM",
                      time_occ="1200", area="01", vict_descent="W", premis_desc='A "B", C',
                      weapon_cd="101", lat="34.05", lon="-118.25"),
        incident_line(dr_no=2, date_rptd="01/09/2015 12:00:00 AM", date_occ="02/01/2015 01:00:00 PM",
                      time_occ="459", area="1", vict_descent="B", premis_desc="STREET",
                      weapon_cd="200", lat="34.05", lon="-118.25"),
        incident_line(dr_no=3, date_rptd="", date_occ="03/01/2015 01:00:00 PM", time_occ="500", area="2",
                      vict_descent="H", premis_desc="STREET", weapon_cd="1", lat="0", lon="0"),
        incident_line(dr_no=4, date_rptd="garbage", date_occ="garbage", time_occ="", area="99",
                      vict_descent="-", premis_desc="STREET", weapon_cd="", lat="0.0", lon="-118.3"),
        incident_line(dr_no=5, date_rptd="02/10/2015 03:00:00 PM", date_occ="02/10/2015 03:00:00 PM",
                      time_occ="2359", area="2", vict_descent="W", premis_desc="STREET", weapon_cd="150",
                      lat="34.10", lon=""),
    ]
    f2 = [
        incident_line(dr_no=6, date_rptd="02/11/2016 03:00:00 PM", date_occ="02/11/2015 03:00:00 PM",
                      time_occ="2100", area="2", vict_descent="W", premis_desc="STREET", weapon_cd="120",
                      lat="34.10", lon="-118.20"),
        incident_line(dr_no=7, date_rptd="03/11/2016 03:00:00 PM", date_occ="03/11/2015 03:00:00 PM",
                      time_occ="0", area="2", vict_descent="A", premis_desc="STREET", weapon_cd="130",
                      lat="34.10", lon="-118.20"),
    ]
    p1, p2 = d / "inc_2010.csv", d / "inc_2020.csv"
    p1.write_text(csv_text(f1, INCIDENT_HEADER))
    # second file: "AREA" header without the trailing space, plus a blank line
    header2 = [h.strip() for h in INCIDENT_HEADER]
    p2.write_text(csv_text(f2, header2) + "\n")
    return str(p1), str(p2)
