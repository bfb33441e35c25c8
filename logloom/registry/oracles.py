"""Independent SQL for the registered queries, runnable by DuckDB on the given tables.

Patterns, words, names and thresholds below are fixed values: they restate the rules of the data formats and of the report.
"""

SYSTEM_LINES = r"""
stamped AS (
  SELECT *, strftime(ts, '%Y-%m-%d %H:%M:%S') AS stamp FROM events
),
system_lines AS (
  SELECT
    CASE WHEN event_id % 97 = 0 THEN '    continued'
         WHEN event_id % 101 = 0 THEN substr(stamp, 1, 4) || '-13' || substr(stamp, 8)
         WHEN event_id % 103 = 0 THEN substr(stamp, 1, 10)
         ELSE stamp END
    || CASE WHEN event_id % 89 = 0 THEN ' ' ELSE ', ' END
    || rpad(CASE WHEN event_type = 'error' THEN 'Error'
                 WHEN event_type = 'signup' THEN 'Warning'
                 WHEN event_type = 'purchase' AND user_id % 10 = 0 THEN 'Critical'
                 WHEN event_id % 107 = 0 THEN 'Notice'
                 ELSE 'Info' END, 22, ' ')
    || rpad(CASE WHEN user_id % 12 < 3 THEN 'CBS' WHEN user_id % 12 < 5 THEN 'CSI' WHEN user_id % 12 = 5 THEN 'SQM'
                 WHEN user_id % 12 = 6 THEN 'DPX' WHEN user_id % 12 = 7 THEN 'WUA' WHEN user_id % 12 = 8 THEN 'TRI'
                 WHEN user_id % 12 = 9 THEN 'NET' WHEN user_id % 12 = 10 THEN 'GPO' ELSE '-' END, 7, ' ')
    || 'Session: ' || event_id || ' ' || event_type || ' package_' || (user_id % 50)
    || ' hr 0x' || hex(event_id + 2147483648)
    || ' ref @' || lpad(lower(hex(event_id * 7919)), 8, '0')
    || ' props ' || props
    || CASE WHEN event_id % 109 = 0 THEN ', Warning in CSI  again' ELSE '' END AS value,
    event_id
  FROM stamped
)"""

PARSED_COLUMNS = r"""
  SELECT * EXCLUDE (value, event_id), trim(regexp_replace(regexp_replace(regexp_replace(Content,
      '0x[0-9A-Fa-f]+', '<HEX>', 'g'), '\b\d+\b', '<NUM>', 'g'), '@[0-9A-Fa-f]{{6,}}', '@<ID>', 'g')) AS EventTemplate
  FROM (
    SELECT
      regexp_extract(value, '^(\d{{4}}-\d{{2}}-\d{{2}})', 1) AS Date,
      regexp_extract(value, '^\d{{4}}-\d{{2}}-\d{{2}} (\d{{2}}:\d{{2}}:\d{{2}})', 1) AS Time,
      regexp_extract(value, ',\s*(Info|Warning|Error|Debug|Critical|Verbose)', 1) AS Level,
      regexp_extract(value, '({names})', 1) AS Component,
      regexp_extract(value, '(?:{names})\s+(.*)', 1) AS Content, value, event_id
    FROM system_lines
  ) WHERE Date <> ''
"""
PARSED = "parsed AS (" + PARSED_COLUMNS.format(names="CBS|CSI") + ")"
ODD_NAMES = {"CBS": "C++", "CSI": "^SI", "SQM": "S.M", "DPX": "[DPX]", "WUA": "W|A", "TRI": "C+", "NET": "N\\T", "GPO": "(GPO"}


def _odd_lines() -> str:
    value = "value"
    for name, odd in ODD_NAMES.items():
        value = f"replace({value}, ' {name} ', ' {odd} ')"
    return f"odd_lines AS (SELECT {value} AS value, event_id FROM system_lines)"


ODD_PARSED = "odd_parsed AS (" + PARSED_COLUMNS.replace("system_lines", "odd_lines").format(
    names=r"C\+\+|\^SI|S\.M|\[DPX\]|W\|A|C\+|N\\T|\(GPO"
) + ")"
WIDE_PARSED = "wide_parsed AS (" + PARSED_COLUMNS.format(names="CBS|CSI|SQM|DPX|WUA|TRI|NET|GPO") + ")"

TIMED = """
timed AS (
  SELECT *, CASE WHEN Time <> '' THEN try_cast(Date || ' ' || Time AS TIMESTAMP) END AS Timestamp FROM parsed
)"""

HOURS = """
hours AS (
  SELECT date_trunc('hour', Timestamp)::TIMESTAMP AS Hour_Window,
         count(*) AS Total_Logs,
         count(*) FILTER (Component = 'CBS') AS CBS_Count,
         count(*) FILTER (Component = 'CSI') AS CSI_Count,
         count(DISTINCT EventTemplate) AS Unique_Templates,
         count(DISTINCT Component) AS Active_Components,
         round((count(*) FILTER (Component = 'CSI'))::DECIMAL(18, 0) / count(*), 4)::DOUBLE AS CSI_Ratio
  FROM timed WHERE Timestamp IS NOT NULL GROUP BY 1
)"""

COMPONENTS = "component_volume AS (SELECT Component, count(*) AS Total_Logs FROM parsed GROUP BY 1)"
WIDE_COMPONENTS = "wide_volume AS (SELECT Component, count(*) AS Total_Logs FROM wide_parsed GROUP BY 1)"
LEVELS = "severity_levels AS (SELECT Level, count(*) AS Total_Logs FROM parsed GROUP BY 1)"
TEMPLATES = """
top_templates AS (
  SELECT EventTemplate, count(*) AS Actions FROM parsed GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10
)"""

RANKED = """
ranked AS (
  SELECT CASE WHEN Component = '' THEN 'Unlabeled' ELSE Component END AS Component, Total_Logs,
         Total_Logs / (SELECT sum(Total_Logs) FROM wide_volume)::DOUBLE * 100 AS SharePct,
         (dense_rank() OVER (ORDER BY Total_Logs DESC))::INTEGER AS Rank
  FROM wide_volume
)"""

COMPARED = """
compared AS (
  SELECT r.Component, r.Total_Logs, r.SharePct, r.Rank,
         round_even(r.Total_Logs / b.Total_Logs * 1000, 0) / 1000 AS Vs_Benchmark,
         round_even((r.Total_Logs - b.Total_Logs) / b.Total_Logs * 100 * 100, 0) / 100 AS RelativeGapPct
  FROM ranked r, (SELECT Total_Logs::DOUBLE AS Total_Logs FROM ranked WHERE Component = 'CSI') b
  WHERE r.Component IN ('CBS', 'CSI', 'SQM', 'Unlabeled')
)"""

METRIC_ROWS = """
metric_rows AS (
  SELECT event_id, "Time stamp", "Server",
         CASE WHEN cpu > 85 AND response > 700 THEN 'ERROR' WHEN cpu > 65 THEN 'WARNING' ELSE 'INFO' END AS "Level",
         response AS "Response Time (ms)", cpu AS "CPU (%)", memory AS "Memory (GB)", requests AS "Requests"
  FROM (
    SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS "Time stamp",
           'SERVER_' || (user_id % 3 + 1) AS "Server",
           (event_id % 901 + 100)::INTEGER AS response, (event_id % 76 + 20)::INTEGER AS cpu,
           value AS memory, (event_id % 451 + 50)::INTEGER AS requests
    FROM events
  )
)"""

METRIC_LINES = """
metric_lines AS (
  SELECT CASE WHEN event_id % 97 = 0 THEN 'garbage line'
              WHEN event_id % 101 = 0
                THEN "Time stamp" || ' | ' || "Server" || ' | ' || "Level" || ' | Response Time = ms | CPU=70%'
              WHEN event_id % 103 = 0 THEN replace(value, 'ms |', '.9ms |')
              ELSE value END AS value
  FROM (
    SELECT *, "Time stamp" || ' | ' || "Server" || ' | ' || "Level"
           || ' | Response Time = ' || "Response Time (ms)" || 'ms | CPU=' || "CPU (%)" || '% | Memory='
           || "Memory (GB)" || 'GB | Requests=' || "Requests" AS value
    FROM metric_rows
  )
)"""

METRICS = r"""
metrics AS (
  SELECT p[1] AS "Time stamp", p[2] AS "Server", p[3] AS "Level",
         trunc(try_cast(regexp_extract(p[4], '\d+\.?\d*', 0) AS DOUBLE))::INTEGER AS "Response Time (ms)",
         trunc(try_cast(regexp_extract(p[5], '\d+\.?\d*', 0) AS DOUBLE))::INTEGER AS "CPU (%)",
         try_cast(regexp_extract(p[6], '\d+\.?\d*', 0) AS DOUBLE) AS "Memory (GB)",
         trunc(try_cast(regexp_extract(p[7], '\d+\.?\d*', 0) AS DOUBLE))::INTEGER AS "Requests"
  FROM (SELECT string_split(value, ' | ') AS p FROM metric_lines)
)"""

STAGES = """
stages AS (
  SELECT CASE event_type WHEN 'click' THEN 'Component Volume' WHEN 'view' THEN 'Severity Levels'
                         WHEN 'purchase' THEN 'Top Event Templates' WHEN 'error' THEN 'Text Summary'
                         ELSE 'Unknown Stage' END AS Process,
         CASE event_type WHEN 'click' THEN 2 WHEN 'view' THEN 3 WHEN 'purchase' THEN 4 WHEN 'error' THEN 1 ELSE 6 END
           AS Stage_Order,
         CASE WHEN user_id % 3 = 0 THEN '2 Worker Nodes' ELSE '1 Worker Node' END AS "Worker Setup",
         sum(value::DECIMAL(18, 2))::DOUBLE AS Seconds
  FROM events GROUP BY ALL
)"""


RULE_SCORES = """
rule_scores AS (
  SELECT *, round(Total_Logs - (SELECT quantile_cont(Total_Logs::DOUBLE, 0.03) FROM hours), 6) AS Anomaly_Score,
         Total_Logs < (SELECT quantile_cont(Total_Logs::DOUBLE, 0.03) FROM hours) AS Is_Anomaly
  FROM hours
)"""


def _with(*tables: str, select: str) -> str:
    return f"WITH {', '.join(tables)} {select}"


SYSTEM = (SYSTEM_LINES, PARSED)
WIDE = (SYSTEM_LINES, WIDE_PARSED, WIDE_COMPONENTS, RANKED)
HOURLY = (*SYSTEM, TIMED, HOURS)
METRIC = (METRIC_ROWS, METRIC_LINES, METRICS)
FEATURES = ("Total_Logs", "CBS_Count", "CSI_Count", "Unique_Templates", "Active_Components", "CSI_Ratio")


def _standardized() -> str:
    columns = ", ".join(
        f"round(({name} - avg({name}) OVER ()) / coalesce(nullif(stddev_pop({name}) OVER (), 0), 1), 6) AS {name}_Z"
        for name in FEATURES
    )
    return f"SELECT Hour_Window, {columns} FROM hours"


COMPONENT_VOLUME = _with(*SYSTEM, COMPONENTS, select="SELECT * FROM component_volume")
SEVERITY_LEVELS = _with(*SYSTEM, LEVELS, select="SELECT * FROM severity_levels")
HOURLY_FEATURES = _with(*HOURLY, select="SELECT * FROM hours")

ORACLES: dict[str, str] = {
    "scan_text": _with(SYSTEM_LINES, select="SELECT value FROM system_lines"),
    "scan_text_dir": _with(METRIC_ROWS, METRIC_LINES, select="SELECT value FROM metric_lines"),
    "scan_limit": _with(SYSTEM_LINES, select="SELECT value FROM system_lines ORDER BY event_id LIMIT 2500"),
    "scan_parquet": COMPONENT_VOLUME,
    "scan_first_base": SEVERITY_LEVELS,
    "scan_guarded": SEVERITY_LEVELS,
    "sink_replaced": COMPONENT_VOLUME,
    "batch_from_mapping": COMPONENT_VOLUME,
    "run_metrics": _with(
        *HOURLY,
        COMPONENTS,
        LEVELS,
        TEMPLATES,
        select="""
        SELECT Process, '1 Worker Node' AS "Worker Setup", n AS "Rows", TRUE AS Has_Bytes FROM (
          SELECT 'Component Volume' AS Process, count(*) AS n FROM component_volume
          UNION ALL SELECT 'Severity Levels', count(*) FROM severity_levels
          UNION ALL SELECT 'Top Event Templates', count(*) FROM top_templates
          UNION ALL SELECT 'Anomaly Features', count(*) FROM hours)""",
    ),
    "bounded_batch_results": _with(
        *HOURLY,
        COMPONENTS,
        LEVELS,
        TEMPLATES,
        select="""
        SELECT '1_component_volume' AS Result, Component AS Key, Total_Logs AS Line_Count FROM component_volume
        UNION ALL SELECT '2_severity_levels', Level, Total_Logs FROM severity_levels
        UNION ALL SELECT '3_most_frequent_actions', EventTemplate, Actions FROM top_templates
        UNION ALL SELECT '4_anomaly_features', Hour_Window::VARCHAR, Total_Logs FROM hours""",
    ),
    "top_mostly_unique": _with(
        *SYSTEM,
        select="""
        SELECT EventTemplate, Actions, Way FROM (
          SELECT CASE WHEN length(Content) % 2 = 0 THEN Component WHEN length(Content) % 3 = 0 THEN 'at ' || Time ELSE Content END AS EventTemplate,
                 count(*) AS Actions FROM parsed GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3), (VALUES ('counters'), ('all values')) w(Way)""",
    ),
    "hours_of_two_runs": _with(*HOURLY, select="SELECT * EXCLUDE (Unique_Templates), TRUE AS Within FROM hours"),
    "forest_properties": """
        SELECT tree_id::BIGINT AS tree_id, 1::BIGINT AS Leaves_Over_Splits, TRUE AS Splits_In_Range, TRUE AS Depth_Limited, TRUE AS Leaves_Fit_Sample
        FROM range(8) r(tree_id)""",
    "scan_or_empty": SEVERITY_LEVELS,
    "sink_parquet_roundtrip": HOURLY_FEATURES,
    "sink_mirror": _with(*SYSTEM, select="SELECT EventTemplate, count(*) AS Actions FROM parsed GROUP BY 1"),
    "sink_text_roundtrip": _with(METRIC_ROWS, select="SELECT * EXCLUDE (event_id) FROM metric_rows"),
    "system_batch_results": _with(
        *HOURLY,
        COMPONENTS,
        LEVELS,
        TEMPLATES,
        select="""
        SELECT '1_component_volume' AS Result, Component AS Key, Total_Logs AS Line_Count FROM component_volume
        UNION ALL SELECT '2_severity_levels', Level, Total_Logs FROM severity_levels
        UNION ALL SELECT '3_most_frequent_actions', EventTemplate, Actions FROM top_templates
        UNION ALL SELECT '4_anomaly_features', Hour_Window::VARCHAR, Unique_Templates FROM hours""",
    ),
    "metrics_batch_results": _with(
        *METRIC,
        select="""
        SELECT 'errors' AS Result, "Server", count(*) AS Lines, NULL::DOUBLE AS Peak FROM metrics WHERE "Level" = 'ERROR' GROUP BY 2
        UNION ALL
        SELECT 'memory', "Server", count(*), max("Memory (GB)") FROM metrics
        WHERE "Memory (GB)" > (SELECT avg("Memory (GB)") FROM metrics) GROUP BY 2""",
    ),
    "report_results": _with(
        *HOURLY,
        COMPONENTS,
        LEVELS,
        TEMPLATES,
        select="""
        SELECT Report, Key, round(Value, 6) AS Value FROM (
          SELECT 'component_comparison' AS Report, Name AS Key, Total_Logs / (SELECT sum(Total_Logs) FROM component_volume)::DOUBLE * 100 AS Value
            FROM (SELECT CASE WHEN Component = '' THEN 'Unlabeled' ELSE Component END AS Name, Total_Logs FROM component_volume)
          UNION ALL SELECT 'component_metric', CASE WHEN Component = '' THEN 'Unlabeled' ELSE Component END, Total_Logs FROM component_volume
          UNION ALL SELECT 'component_share', CASE WHEN Component = '' THEN 'Unlabeled' ELSE Component END,
                           Total_Logs / (SELECT sum(Total_Logs) FROM component_volume)::DOUBLE * 100 FROM component_volume
          UNION ALL SELECT 'severity_mix', Level, Total_Logs FROM severity_levels
          UNION ALL SELECT 'severity_summary', format('{:.3f}% ({:,} of {:,})', e / n * 100, e, n), e / n * 100
            FROM (SELECT sum(Total_Logs)::BIGINT AS n, (sum(Total_Logs) FILTER (lower(Level) = 'error'))::BIGINT AS e FROM severity_levels)
          UNION ALL SELECT 'template_concentration', CASE WHEN length(EventTemplate) <= 80 THEN EventTemplate ELSE EventTemplate[1:77] || '...' END,
                           Actions FROM (SELECT * FROM top_templates ORDER BY Actions DESC, EventTemplate LIMIT 8)
          UNION ALL SELECT 'indexed_trend', Component || ' ' || Hour_Window::VARCHAR, Line_Count / Base * 100
            FROM (SELECT *, first_value(Line_Count) OVER (PARTITION BY Component ORDER BY Hour_Window
                    ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS Base
                  FROM (SELECT Hour_Window, 'CBS' AS Component, CBS_Count AS Line_Count FROM hours
                        UNION ALL SELECT Hour_Window, 'CSI', CSI_Count FROM hours)) WHERE Base <> 0
          UNION ALL SELECT 'anomaly_kpis', 'windows', count(*) FROM hours)""",
    ),
    "parse_odd_names": _with(
        SYSTEM_LINES, _odd_lines(), ODD_PARSED, select="SELECT Date, Time, Level, Component, Content, EventTemplate FROM odd_parsed"
    ),
    "timings_appended": _with(STAGES, select='SELECT Process, "Worker Setup", Seconds, Stage_Order FROM stages'),
    "quantile_fenced": """
        SELECT s AS Share, round((SELECT quantile_cont(value, list_value(0.01, 0.03, 0.5, 0.97)) FROM events)[i], 6) AS Quantile
        FROM (VALUES (0.01::DOUBLE, 1), (0.03, 2), (0.5, 3), (0.97, 4)) shares(s, i)""",
    "status_by_rule": _with(
        *HOURLY,
        RULE_SCORES,
        select="""
        SELECT *, CASE WHEN Is_Anomaly THEN 'Anomaly 🔴' ELSE 'Normal 🟢' END AS Status, greatest(CSI_Count, 500) AS dot_size
        FROM rule_scores""",
    ),
    "flags_by_rule": _with(*HOURLY, RULE_SCORES, select="SELECT * FROM rule_scores WHERE Is_Anomaly"),
    "kpis_by_rule": _with(
        *HOURLY,
        RULE_SCORES,
        select="""
        SELECT *, format('{:.1f}%', Anomaly_Rate) AS Anomaly_Rate_Text
        FROM (SELECT count(*) AS Total_Windows, count(*) FILTER (Is_Anomaly) AS Flagged_Windows,
                     count(*) FILTER (Is_Anomaly) / count(*) * 100 AS Anomaly_Rate FROM rule_scores)""",
    ),
    "triage_by_rule": _with(
        *HOURLY,
        RULE_SCORES,
        select="""
        SELECT Hour_Window, Total_Logs, CBS_Count, CSI_Count, CSI_Ratio, Anomaly_Score FROM rule_scores
        WHERE Is_Anomaly ORDER BY Anomaly_Score, Hour_Window LIMIT 20""",
    ),
    "forest_by_hand": _with(
        *HOURLY,
        select="""
        SELECT Hour_Window, round(-pow(2, -(one + two) / 2 / (2 * (ln(7) + 0.5772156649015329) - 2 * 7 / 8.0::DOUBLE)), 9) AS Raw_Score
        FROM (SELECT Hour_Window, CASE WHEN Total_Logs > 14 THEN 2.25::DOUBLE ELSE 1.5 END AS one,
                     CASE WHEN CSI_Count <= 2 THEN 1.0::DOUBLE WHEN Total_Logs <= 20 THEN 2.0 ELSE 3.0 END AS two FROM hours)""",
    ),
    "parse_system_log": _with(
        *SYSTEM, select="SELECT Date, Time, Level, Component, Content, EventTemplate FROM parsed"
    ),
    "event_template": _with(*SYSTEM, select="SELECT Content, EventTemplate FROM parsed"),
    "assemble_timestamp": _with(*SYSTEM, TIMED, select="SELECT Date, Time, Timestamp FROM timed"),
    "parse_server_metrics": _with(*METRIC, select="SELECT * FROM metrics"),
    "classify_severity": _with(
        METRIC_ROWS, select='SELECT event_id, "CPU (%)", "Response Time (ms)", "Level" FROM metric_rows'
    ),
    "component_volume": COMPONENT_VOLUME,
    "severity_levels": SEVERITY_LEVELS,
    "top_templates": _with(*SYSTEM, TEMPLATES, select="SELECT * FROM top_templates"),
    "hourly_features": HOURLY_FEATURES,
    "errors_by_server": _with(
        *METRIC,
        select="""SELECT "Server", count(*) AS Total_errors FROM metrics WHERE "Level" = 'ERROR' GROUP BY 1""",
    ),
    "memory_over_average": _with(
        *METRIC,
        select="""
        SELECT "Server", count(*) AS times_over_avg, max("Memory (GB)") AS peak_memory_gb FROM metrics
        WHERE "Memory (GB)" > (SELECT avg("Memory (GB)") FROM metrics) GROUP BY 1""",
    ),
    "component_share_rank": _with(*WIDE, select="SELECT * FROM ranked"),
    "default_components": _with(
        *WIDE, select="SELECT Component, Total_Logs FROM ranked ORDER BY Total_Logs DESC, Component LIMIT 6"
    ),
    "benchmark_compare": _with(*WIDE, COMPARED, select="SELECT * FROM compared"),
    "component_table": _with(
        *WIDE,
        COMPARED,
        select="""
        SELECT Component, Total_Logs, SharePct AS "Share (%)", Rank, Vs_Benchmark AS "Multiple vs Benchmark",
               RelativeGapPct AS "Gap vs Benchmark (%)" FROM compared""",
    ),
    "component_metric_view": _with(
        *WIDE,
        COMPARED,
        select="""
        SELECT 'Absolute' AS View, Component, Total_Logs::DOUBLE AS Value FROM compared
        UNION ALL SELECT 'Relative', Component, SharePct FROM compared""",
    ),
    "component_cards": _with(
        *WIDE,
        COMPARED,
        select="""
        SELECT Component || CASE WHEN Component = 'CSI' THEN ' (Benchmark)' ELSE '' END AS Title,
               format('{:,}', Total_Logs) AS Value,
               format('{:+.1f}', RelativeGapPct) || '% vs CSI' AS Delta,
               'Rank #' || Rank || ' • Share ' || format('{:.2f}', SharePct) || '%' AS Note
        FROM compared""",
    ),
    "selected_share": _with(
        *WIDE,
        select="""
        SELECT Component, Total_Logs, Total_Logs / (sum(Total_Logs) OVER ())::DOUBLE * 100 AS SelectedSharePct
        FROM ranked WHERE Component IN ('CBS', 'CSI', 'SQM', 'Unlabeled')""",
    ),
    "indexed_trend": _with(
        *HOURLY,
        select="""
        SELECT Hour_Window, Component, Line_Count / Base * 100 AS Indexed
        FROM (SELECT Hour_Window, Component, Line_Count, first_value(Line_Count) OVER (PARTITION BY Component
                ORDER BY Hour_Window ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS Base
              FROM (SELECT Hour_Window, 'CBS' AS Component, CBS_Count AS Line_Count FROM hours
                    UNION ALL SELECT Hour_Window, 'CSI', CSI_Count FROM hours))
        WHERE Base <> 0""",
    ),
    "severity_summary": _with(
        *SYSTEM,
        LEVELS,
        select="""
        SELECT *, format('{:.3f}% ({:,} of {:,})', Error_Pct, Error_Logs, Total_Logs) AS Error_Text
        FROM (SELECT *, CASE WHEN Total_Logs = 0 THEN 0.0 ELSE Error_Logs / Total_Logs * 100 END AS Error_Pct
              FROM (SELECT sum(Total_Logs)::BIGINT AS Total_Logs,
                           coalesce(sum(Total_Logs) FILTER (lower(Level) = 'info'), 0)::BIGINT AS Info_Logs,
                           coalesce(sum(Total_Logs) FILTER (lower(Level) = 'error'), 0)::BIGINT AS Error_Logs
                    FROM severity_levels))""",
    ),
    "template_concentration": _with(
        *SYSTEM,
        TEMPLATES,
        select="""
        SELECT CASE WHEN length(EventTemplate) <= 80 THEN EventTemplate ELSE EventTemplate[1:77] || '...' END
                 AS Short_Name,
               EventTemplate, Actions, format('{:,}', Actions) AS Actions_Text
        FROM top_templates ORDER BY Actions DESC, EventTemplate LIMIT 8""",
    ),
    "stage_timings": _with(STAGES, select='SELECT Process, "Worker Setup", Seconds, Stage_Order FROM stages'),
    "stage_speedup": _with(
        STAGES,
        select="""
        , wide AS (SELECT Process, max(Seconds) FILTER ("Worker Setup" = '1 Worker Node') AS one,
                          max(Seconds) FILTER ("Worker Setup" = '2 Worker Nodes') AS two FROM stages GROUP BY 1)
        SELECT Process, one AS "1 Worker Time (s)", two AS "2 Worker Time (s)",
               round_even(one / two * 100, 0) / 100 AS "Speedup (1W / 2W)"
        FROM (SELECT * FROM wide UNION ALL
              SELECT 'All Stages', sum(one::DECIMAL(18, 6))::DOUBLE, sum(two::DECIMAL(18, 6))::DOUBLE FROM wide WHERE one IS NOT NULL AND two IS NOT NULL)""",
    ),
    "standardize_features": _with(*HOURLY, select=_standardized()),
    "contamination_tier": _with(
        *HOURLY,
        select="""
        SELECT count(*) AS Windows,
               (CASE WHEN count(*) < 10 THEN 0.1 WHEN count(*) < 100 THEN 0.05 ELSE 0.03 END)::DOUBLE AS Contamination
        FROM hours""",
    ),
    "quantile_threshold": _with(
        *HOURLY,
        select="""
        SELECT Hour_Window, Raw, round(Raw - q, 6) AS Score, Raw - q < 0 AS Flag
        FROM (SELECT Hour_Window, Total_Logs::DOUBLE AS Raw FROM hours),
             (SELECT quantile_cont(Total_Logs::DOUBLE, 0.03) AS q FROM hours)""",
    ),
}
