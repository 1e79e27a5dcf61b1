"""DuckDB SQL for the queries that SQL can express."""

from . import collocations, quality_rules, secret_scan, warc

SQL = {
    "op3_secret_scan": secret_scan.report_sql(),
    "op4_quality_rules": quality_rules.REPORT_SQL,
    "op7_warc": warc.ROUND_TRIP_SQL,
    "op13_phrase_collocations": collocations.collocations_sql(),
}
