"""Values the results depend on.

Everything below is a fixed value of the data formats or of the report; change one and results change.
"""

# Words recognised in a system-log line, in matching order.
LEVELS = ("Info", "Warning", "Error", "Debug", "Critical", "Verbose")
COMPONENTS = ("CBS", "CSI")

# Patterns of a system-log line.
DATE_PATTERN = r"^(\d{4}-\d{2}-\d{2})"
TIME_PATTERN = r"^\d{4}-\d{2}-\d{2} (\d{2}:\d{2}:\d{2})"
STAMP_WIDTH = 19

# What a message is reduced by to become a template, applied in this order.
# (pattern, replacement, text that must be present for the pattern to match; None = no such text)
TEMPLATE_RULES = (
    (r"0x[0-9A-Fa-f]+", "<HEX>", "0x"),
    (r"\b\d+\b", "<NUM>", None),
    (r"@[0-9A-Fa-f]{6,}", "@<ID>", "@"),
)

# A server-metric line.
FIELD_SEPARATOR = " | "
NUMBER_PATTERN = r"\d+\.?\d*"

# The severity rule of a server-metric row.
ERROR_CPU_ABOVE, ERROR_RESPONSE_ABOVE, WARNING_CPU_ABOVE = 85, 700, 65

# The report.
UNLABELED = "Unlabeled"
TOP_TEMPLATES, REPORT_TEMPLATES, DEFAULT_SELECTION = 10, 8, 6
TEMPLATE_WIDTH = 80
SUMMARY_STAGE = "Text Summary"
RESULT_STAGES = ("Component Volume", "Severity Levels", "Top Event Templates", "Anomaly Features")
STAGES = (SUMMARY_STAGE, *RESULT_STAGES)
ALL_STAGES = "All Stages"
WORKER_SETUPS = ("1 Worker Node", "2 Worker Nodes")

TITLE_SLOW, TITLE_FAST, TITLE_SPEEDUP = "1 Worker Time (s)", "2 Worker Time (s)", "Speedup (1W / 2W)"
TITLE_SHARE, TITLE_MULTIPLE, TITLE_GAP = "Share (%)", "Multiple vs Benchmark", "Gap vs Benchmark (%)"
CARD_BADGE, CARD_DELTA, CARD_RANK, CARD_SHARE = " (Benchmark)", "% vs ", "Rank #", " • Share "

# The anomaly model.
FEATURES = ("Total_Logs", "CBS_Count", "CSI_Count", "Unique_Templates", "Active_Components", "CSI_Ratio")
FOREST_TREES, FOREST_SAMPLE, FOREST_SEED = 200, 256, 42
CONTAMINATION_TIERS = ((10, 0.1), (100, 0.05))  # (row count below, share of rows flagged)
CONTAMINATION_DEFAULT = 0.03
TRIAGE_ROWS, TRIAGE_ROWS_SIMPLIFIED = 20, 5
SMALLEST_DOT = 500
STATUS_ANOMALY, STATUS_NORMAL = "Anomaly 🔴", "Normal 🟢"

# Names of the result tables.
RESULT_COMPONENTS = "1_component_volume"
RESULT_LEVELS = "2_severity_levels"
RESULT_TEMPLATES = "3_most_frequent_actions"
RESULT_HOURS = "4_anomaly_features"
RESULT_SERVER_ERRORS = "errors_by_server"
RESULT_SERVER_MEMORY = "memory_over_average"
REPORT_PREFIX = "report_"
