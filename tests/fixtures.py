"""Hand-made rows with known answers (each row hits a boundary)."""

CRIME_HEADER = ["DATE OCC", "TIME OCC", "Premis Desc", "LAT", "LON"]

# (file, date_occ, time_occ, premis, lat, lon)
CRIMES = [
    ("A", "2019 Jan 05 12:00:00 AM", "0459", "STREET", "34.0500", "-118.2500"),
    ("A", "2019 Jan 06 12:00:00 AM", "0500", "STREET", "34.0500", "-118.2500"),
    ("A", "2019 Jan 07 12:00:00 AM", "1159", "STREET", "34.0600", "-118.2400"),
    ("A", "2019 Feb 01 12:00:00 AM", "1160", "STREET", "34.2000", "-118.4500"),
    ("A", "2019 Feb 02 12:00:00 AM", "1200", "STREET", "34.2000", "-118.4500"),
    ("A", "2019 Mar 01 12:00:00 AM", "1659", "STREET", "34.0500", "-118.2500"),
    ("A", "2019 Apr 01 12:00:00 AM", "1700", "SIDEWALK", "34.0500", "-118.2500"),
    ("A", "2019 Dec 31 11:59:00 PM", "2059", "STREET", "0", "0"),
    ("B", "2019 Dec 31 12:00:00 AM", "2100", "STREET", "34.1900", "-118.4400"),
    ("B", "2020 Jan 01 12:00:00 AM", "2359", "STREET", "34.0500", "-118.2500"),
    ("B", "2020 Jan 02 12:00:00 AM", None, "STREET", "34.0500", "-118.2500"),
    ("B", "2020 Feb 02 01:05:00 PM", "0730", None, "34.0500", "-118.2500"),
    ("B", "2020 Mar 02 01:05:00 PM", "1730", "STREET", None, None),
]

Q1_EXPECTED = [("night", 45.45), ("afternoon", 18.18), ("evening", 18.18), ("morning", 18.18)]

Q2_RANK_COMBINED = [(2019, 1, 3, 1), (2019, 2, 2, 2), (2019, 12, 2, 2),
                    (2020, 1, 2, 1), (2020, 2, 1, 2), (2020, 3, 1, 2)]
Q2_ROW_NUMBER_PER_SOURCE = [(2019, 1, 3, 1), (2019, 2, 2, 2), (2019, 3, 1, 3),
                            (2020, 1, 2, 1), (2020, 2, 1, 2), (2020, 3, 1, 3)]

# (ord, division, lon, lat)
STATIONS = [(0, "CENTRAL", -118.25, 34.05), (1, "TWIN", -118.25, 34.05), (2, "VALLEY", -118.45, 34.20)]
Q4_EXPECTED = {"CENTRAL": (1397.38, 9), "VALLEY": (0.48, 3)}

# (ZCTA20, POP20, HOUSING20)
BLOCKS = [("90001", 10, 4), ("90001", 0, 2), ("90002", 0, 5), (None, 1, 1), ("90003", 7, 3),
          ("90004", 8, 1), ("90005", 8, 3), ("90006", None, 9), ("90006", 4, 2)]
# (Zip Code, name, Estimated Median Income)
INCOME = [("90001", "A", "$52,806"), ("90002", "B", "$10,000"), ("90004", "D", "$100"),
          ("90004", "D2", "$300"), ("90005", "E", "--"), ("90006", "F", "$1,000"), ("99999", "Z", "$5")]
Q3_LOOSE = sorted([("90001", 31684.0), ("90002", None), ("90004", 13.0), ("90004", 38.0),
                   ("90005", None), ("90006", 2750.0)], key=lambda r: (r[0], r[1] or -1))
Q3_STRICT = sorted([("90001", 21122.40), ("90004", 12.50), ("90004", 37.50), ("90006", 500.00)])
