"""The two-snapshot raw fixture (invented data) and helpers to write it."""

from __future__ import annotations

import json
import os

SNAP1 = "2021-03-21"
SNAP2 = "2021-03-28"

CIRCUITS_HEADER = "circuitId,circuitRef,name,location,country,lat,lng,alt,url"
RACES_HEADER = "raceId,year,round,circuitId,name,date,time,url"


def _results(rows):
    return "\n".join(json.dumps(r) for r in rows) + "\n"


FILES = {
    SNAP1: {
        "circuits.csv": CIRCUITS_HEADER + "\n"
        "1,north,North Ring,Northtown,Norland,50.5,6.9,\\N,u1\n"
        "2,south,South Park,Southville,Sudland,-33.1,151.2,12,u2\n",
        "races.csv": RACES_HEADER + "\n"
        "10,2020,1,1,Norland GP,2020-03-15,14:00:00,r10\n"
        "11,2020,2,2,Sudland GP,2020-04-05,\\N,r11\n",
        "drivers.json": _results([
            {"driverId": 100, "driverRef": "ada", "name": {"forename": "Ada", "surname": "Nord"},
             "number": 7, "code": "ADA", "dob": "1990-01-02", "nationality": "Norlander",
             "url": "d100"},
            {"driverId": 101, "driverRef": "bo", "name": {"forename": "Bo", "surname": "Sud"},
             "number": "\\N", "code": "\\N", "dob": "1991-02-03", "nationality": "Sudlander",
             "url": "d101"},
            {"driverId": 102, "driverRef": "cy", "name": {"forename": "Cy", "surname": "West"},
             "number": 9, "code": "CYW", "dob": "1992-03-04", "nationality": "Westlander",
             "url": "d102"},
        ]),
        "constructors.json": _results([
            {"constructorId": 200, "constructorRef": "alpha", "name": "Alpha",
             "nationality": "Norlander", "url": "c200"},
            {"constructorId": 201, "constructorRef": "beta", "name": "Beta",
             "nationality": "Sudlander", "url": "c201"},
        ]),
        "results.json": _results([
            {"resultId": 1000, "raceId": 10, "driverId": 100, "constructorId": 200, "grid": 1,
             "position": 1, "points": 25, "statusId": 1},
            {"resultId": 1001, "raceId": 10, "driverId": 101, "constructorId": 201, "grid": 2,
             "position": 2, "points": 18, "statusId": 1},
            {"resultId": 1002, "raceId": 10, "driverId": 102, "constructorId": 201, "grid": 3,
             "position": "\\N", "points": 0, "statusId": 5},
            {"resultId": 1003, "raceId": 11, "driverId": 100, "constructorId": 200, "grid": 1,
             "position": 2, "points": 18, "statusId": 1},
            {"resultId": 1004, "raceId": 11, "driverId": 101, "constructorId": 201, "grid": 2,
             "position": 1, "points": 25, "statusId": 1},
            {"resultId": 1005, "raceId": 11, "driverId": 101, "constructorId": 201, "grid": 4,
             "position": 5, "points": 10, "statusId": 1},
            {"resultId": 1006, "raceId": 11, "driverId": 102, "constructorId": 201, "grid": 3,
             "position": 3, "points": 15, "statusId": 1},
            {"resultId": 1007, "raceId": 99, "driverId": 102, "constructorId": 201, "grid": 3,
             "position": 1, "points": 25, "statusId": 1},
        ]),
        "pit_stops.json": _results([
            {"raceId": 10, "driverId": 100, "stop": 1, "lap": 12, "time": "14:20:01",
             "duration": "22.5", "milliseconds": 22500},
        ]),
        "lap_times/lap_times_split_1.csv": "10,100,1,1,1:38.0,98000\n10,100,2,1,1:37.0,97000\n",
        "qualifying/qualifying_split_1.json": '[\n {"qualifyId":1,"raceId":10,"driverId":100,'
        '"constructorId":200,"number":7,"position":1,\n  "q1":"1:30.0","q2":"1:29.0",'
        '"q3":"\\\\N"}\n]\n',
    },
    SNAP2: {
        "circuits.csv": CIRCUITS_HEADER + "\n1,north,North Ring,Northtown,Norland,50.5,6.9,627,u1\n",
        "races.csv": RACES_HEADER + "\n"
        "11,2020,2,2,Sudland GP,2020-04-05,05:10:00,r11\n"
        "12,2021,1,2,Sudland GP,2021-03-28,15:00:00,r12\n",
        "drivers.json": _results([
            {"driverId": 101, "driverRef": "bo", "name": {"forename": "Bo", "surname": "Sud"},
             "number": 77, "code": "\\N", "dob": "1991-02-03", "nationality": "Sudlander",
             "url": "d101"},
        ]),
        "constructors.json": _results([
            {"constructorId": 200, "constructorRef": "alpha", "name": "Alpha",
             "nationality": "Norlander", "url": "c200"},
            {"constructorId": 201, "constructorRef": "beta", "name": "Beta",
             "nationality": "Sudlander", "url": "c201"},
        ]),
        "results.json": _results([
            {"resultId": 1002, "raceId": 10, "driverId": 102, "constructorId": 201, "grid": 3,
             "position": 10, "points": 1, "statusId": 1},
            {"resultId": 1008, "raceId": 12, "driverId": 100, "constructorId": 201, "grid": 1,
             "position": 1, "points": 25, "statusId": 1},
            {"resultId": 1009, "raceId": 12, "driverId": 102, "constructorId": 200, "grid": 2,
             "position": 2, "points": 25, "statusId": 1},
        ]),
        "pit_stops.json": _results([
            {"raceId": 10, "driverId": 100, "stop": 1, "lap": 12, "time": "14:20:01",
             "duration": "22.6", "milliseconds": 22600},
        ]),
        "lap_times/lap_times_split_1.csv": "10,100,2,1,1:36.5,96500\n",
        "qualifying/qualifying_split_1.json": '[\n {"qualifyId":1,"raceId":10,"driverId":100,'
        '"constructorId":200,"number":7,"position":1,\n  "q1":"1:30.0","q2":"1:29.0",'
        '"q3":"1:28.0"}\n]\n',
    },
}


def write_snapshot(raw_root, folder, files=None):
    for rel, text in (files or FILES[folder]).items():
        p = os.path.join(str(raw_root), folder, rel)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "w") as f:
            f.write(text)


def write_all(raw_root):
    for folder in FILES:
        write_snapshot(raw_root, folder)
