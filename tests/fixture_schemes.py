"""A tiny two-scheme fixture with the edge rows FIXTURES.md asks for."""

from wingspan.sources.readers import Scheme, scheme_detail

SCHEMES = [Scheme("AA", "AAA", "Land of Côte d'Azur", "Ann O'Neil", "ann@example.org"),
           Scheme("BB", "BBB", "Bee Land", "Bo", "bo@example.org")]

SITE_COLS = ("bms_id string, transect_id string, section_id string, bms_site_id int, transect_length double, "
             "section_length double, monitoring_type string, longitude double, latitude double, geo_info_level string")
SITES = [
    ("AA", "1", "1", 11, 110.0, 50.0, "31", 3000000.0, 2000000.0, "section_centroid"),
    ("AA", "1", "2", 12, 110.0, 60.0, "31", 3000100.0, 2000100.0, "transect_centroid"),
    ("AA", "2", "1", 22, 50.0, 25.0, "31", 3000200.0, 2000200.0, "section_centroid"),
    ("AA", "2", "1", 21, 50.0, 25.01, "31", 3000300.0, 2000300.0, "section_centroid"),
    ("AA", "3", "1", 31, 10.0, 10.0, "31", 3000400.0, 2000400.0, "section_centroid"),
    ("AA", "3", "1", 31, 10.0, 10.0, "2", 3000400.0, 2000400.0, "section_centroid"),
    ("AA", "4", "1", 41, 10.0, 10.0, "31", None, 2000500.0, "other"),
    ("BB", "1", "1", 11, 10.0, 10.0, "31", 4000000.0, 3000000.0, "section_centroid"),
]

VISIT_COLS = ("bms_id string, bms_visit_id int, bms_observer_id string, transect_id string, visit_date string, "
              "start_time string, end_time string, visit_cloud double, visit_wind double, completed string")
VISITS = [
    ("AA", 1, "5", "1", "2023-6-1", "10:00", "11:00", 10.0, 2.0, "1"),
    ("AA", 1, None, "1", "2023-6-1", "10:00", "11:00", 10.0, 2.0, "1"),
    ("AA", None, "6", "1", "2023-6-2", "10:00", "11:00", 10.0, 2.0, "1"),
    ("AA", None, "8", "1", "2023-6-2", "10:00", "11:00", 10.0, 2.0, "1"),
    ("AA", 2, "07", "1", "2023-6-3", "10:00", "11:00", 10.0, 2.0, "1"),
    ("AA", 3, "7", "1", "2023-6-4", "10:00", "11:00", 10.0, 2.0, "1"),
    ("AA", 4, None, "2", "2023-6-5", "10:00", "11:00", 10.0, 2.0, "1"),
    ("AA", 5, "5", "2", "2023-1-5", "10:35:20", "11:00", 2.5, 3.5, "1"),
    ("AA", 6, "5", "2", "2023-6-6", "10:00", "11:00", 3.5, 2.0, "0"),
    ("AA", 7, "5", "2", "2023-6-7", "10:00", "11:00", 10.0, 2.0, "on"),
    ("AA", 8, "5", "2", "2023-6-8", "10:00", "11:00", 10.0, 2.0, "of"),
    ("AA", 9, "5", "2", "2023-6-9", "10:00", "11:00", 10.0, 2.0, None),
    ("BB", 1, "5", "1", "2023-7-1", "09:00", "10:00", 0.0, 0.0, "1"),
]

COUNT_COLS = "bms_id string, bms_visit_id int, bms_site_id int, sci_name string, count double"
COUNTS = [
    ("AA", 5, 11, "Pieris rapae", 3.0),
    ("AA", 5, 12, None, 1.0),
    ("AA", 6, 11, "Unknown one", 2.0),
    ("AA", 6, 31, "Maniola agg", 4.0),
    ("AA", 999, 11, "Pieris rapae", 1.0),
    ("AA", 5, 999, "Pieris rapae", 1.0),
    ("BB", 1, 11, "Pieris rapae", 7.0),
]

CHECKLIST_COLS = "Search_Name string, Accepted_Name string, Systematic_Order int, Aggregate boolean, _ordinal long"
CHECKLIST = [
    ("Pieris rapae", "Pieris rapae", 10, False, 1),
    ("Pieris rapae", "Pieris napi", 11, False, 2),
    (None, "Unnamed", 20, False, 3),
    ("Maniola agg", "Maniola agg", 1001, True, 4),
]


def frames(spark):
    return {
        "schemes": scheme_detail(spark, SCHEMES),
        "sites": spark.createDataFrame(SITES, SITE_COLS),
        "visits": spark.createDataFrame(VISITS, VISIT_COLS),
        "counts": spark.createDataFrame(COUNTS, COUNT_COLS),
        "checklist": spark.createDataFrame(CHECKLIST, CHECKLIST_COLS),
    }
