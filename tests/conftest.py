import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from socialpages.session import build_session  # noqa: E402

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[*]", app_name="socialpages-tests", shuffle_partitions=8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def write_csv(folder, name: str, header: str, lines: list[str], newline: str = "\r\n") -> str:
    """Write a CSV fixture file (header + lines) and return its path."""
    path = os.path.join(str(folder), name)
    with open(path, "w", newline="") as fh:
        fh.write(header + newline)
        for line in lines:
            fh.write(line + newline)
    return path


PAGES_HEADER = "PersonID,Name,Nationality,Country Code,Hobby"
FRIENDS_HEADER = "FriendRel,PersonID,MyFriend,DateOfFriendship,Desc"
ACCESS_HEADER = "AccessID,ByWho,WhatPage,TypeOfAccess,AccessTime"

# A small data set of our own; the answers on it are worked out by hand.
SAMPLE_PAGES = [
    "0,Ann Lee,Latvia,5,Chess",
    "1,Bob Ray,Peru,9,Golf",
    "2,Cy Dow,Latvia,5,Crocheting",
    "3,Di Fox,Chad,3,Running",
    "4,Ed Poe,Peru,9,Chess",
    "5,Flo May,Mali,7,Reading",
]
SAMPLE_FRIENDS = [
    "0,0,1,2018-08-07,Aunt",
    "1,0,2,2018-08-08,Friend",
    "2,0,1,2019-01-01,Friend",  # the edge of rel 0 again
    "3,1,0,2019-01-02,Uncle",
    "4,2,9,2019-01-03,Cousin",  # 9 has no page
    "5,2,3,2019-01-04,Son",
    "6,3,0,2019-01-05,Father",
    "7,4,0,2019-01-06,Sister",
]
SAMPLE_ACCESS = [
    "0,0,1,Viewed,2024-01-05 10:00:00",
    "1,0,1,Liked,2024-01-06 10:00:00",
    "2,1,0,Viewed,2024-01-20 09:00:00",
    "3,2,0,Viewed,2024-02-01 08:00:00",
    "4,3,0,Viewed,2024-01-30 12:00:00",  # exactly at the cutoff used below
    "5,3,2,Viewed,2024-01-10 00:00:00",
    "6,4,5,Viewed,2024-01-29 23:59:59",
    "7,9,0,Viewed,2024-02-10 00:00:00",  # 9 has no page
]


@pytest.fixture(scope="session")
def sample(tmp_path_factory):
    """Paths of the three sample files."""
    folder = tmp_path_factory.mktemp("sample")
    return {
        "pages": write_csv(folder, "pages.csv", PAGES_HEADER, SAMPLE_PAGES),
        "friends": write_csv(folder, "friends.csv", FRIENDS_HEADER, SAMPLE_FRIENDS),
        "access": write_csv(folder, "access_logs.csv", ACCESS_HEADER, SAMPLE_ACCESS),
    }
