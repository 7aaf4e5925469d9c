"""Write the hand-made fixtures as the files the city readers expect."""

import csv
import json
import os

from fixtures import BLOCKS, CRIME_HEADER, CRIMES, INCOME, STATIONS


def write_crime_files(root: str) -> list[str]:
    """File A in the usual column order, file B with the columns reversed."""
    paths = []
    for name, header in (("A", CRIME_HEADER), ("B", list(reversed(CRIME_HEADER)))):
        path = os.path.join(root, f"crimes_{name}.csv")
        with open(path, "w", newline="") as fh:
            w = csv.writer(fh)
            w.writerow(header)
            for row in CRIMES:
                if row[0] != name:
                    continue
                rec = dict(zip(CRIME_HEADER, row[1:]))
                w.writerow(["" if rec[h] is None else rec[h] for h in header])
        paths.append(path)
    return paths


def write_stations(root: str) -> str:
    path = os.path.join(root, "stations.csv")
    with open(path, "w", newline="") as fh:
        w = csv.writer(fh)
        w.writerow(["X", "Y", "DIVISION", "PREC"])
        for order, division, lon, lat in STATIONS:
            w.writerow([lon, lat, division, order])
    return path


def write_blocks(root: str) -> str:
    path = os.path.join(root, "blocks.geojson")
    features = []
    for zcta, pop, housing in BLOCKS:
        features.append({
            "type": "Feature",
            "properties": {"ZCTA20": zcta, "POP20": pop, "HOUSING20": housing, "COUNTY": "X"},
            "geometry": {"type": "Polygon", "coordinates": [[[-118.1, 34.0], [-118.2, 34.0],
                                                             [-118.2, 34.1], [-118.1, 34.0]]]},
        })
    with open(path, "w") as fh:
        json.dump({"type": "FeatureCollection", "features": features}, fh, indent=2)
    return path


def write_income(root: str) -> str:
    path = os.path.join(root, "income.csv")
    with open(path, "w", newline="") as fh:
        w = csv.writer(fh, delimiter=";")
        w.writerow(["Zip Code", "Community", "Estimated Median Income"])
        w.writerows(INCOME)
    return path
