"""They must be equal to the reference's for its results to come out.

Everything here is plain data and the default of a keyword argument somewhere
else, so a caller can replace any of it.
"""

from __future__ import annotations

# Prompt templates, each with one {action} hole.
PROMPT_TEMPLATES = [
    "I need to {action}.",
    "I want to {action}.",
    "I'd like to {action}.",
    "Can you {action}?",
    "How do I {action}?",
    "Help me {action}.",
    "Investigate and {action}.",
    "For this security incident, {action}.",
    "Urgently {action}.",
    "As part of threat hunting, {action}.",
    "For compliance purposes, {action}.",
    "During this investigation, {action}.",
    "{action}.",
    "{action}",
    "Triage this alert by {action}.",
    "Analyze the threat and {action}.",
    "Check if we need to {action}.",
    "The SOC team needs to {action}.",
    "For incident response, {action}.",
]

# A path is kept when it contains one of these.
TARGET_NAMESPACES = [
    "/security/alerts",
    "/security/alerts_v2",
    "/security/incidents",
    "/security/threatIntelligence",
    "/security/tiIndicators",
    "/security/runHuntingQuery",
    "/security/cases",
    "/security/attackSimulation",
    "/security/identities",
    "/identity",
    "/identityProtection",
    "/riskDetections",
    "/security/secureScores",
    "/security/secureScoreControlProfiles",
    "/auditLogs",
    "/security/auditLog",
    "/riskyUsers",
    "/signIns",
    "/security/cases/ediscoveryCases",
    "/deviceManagement",
    "/applications",
    "/servicePrincipals",
    "/identity/conditionalAccess",
    "/directoryAudits",
]

# Path-item keys that are operations.
VALID_METHODS = ["get", "post", "patch", "delete", "put"]

# Parameter locations that become tool properties.
PARAMETER_LOCATIONS = ["path", "query"]

# The property added for a JSON request body.
BODY_PROPERTY = "request_body"
BODY_DESCRIPTION = "JSON body required for this action"

# Candidates for example arguments.
FILTER_CLAUSES = [
    "severity eq 'high'",
    "severity eq 'medium'",
    "status eq 'new'",
    "status eq 'inProgress'",
    "vendorInformation/provider eq 'ASC'",
]
SELECT_FIELDS = ["id", "title", "severity", "status", "assignedTo", "createdDateTime"]
TOP_SIZES = [10, 25, 50, 100]
ORDER_FIELDS = ["createdDateTime", "lastModifiedDateTime", "severity"]
ORDER_DIRECTIONS = ["asc", "desc"]
EXPANSIONS = ["alerts", "evidence", "relatedIncidents"]
SEARCH_TERMS = ["malware", "ransomware", "phishing", "backdoor", "mimikatz"]
USER_NAMES = ["alice", "bob", "charlie", "admin", "service_account"]
USER_DOMAINS = ["contoso.com", "fabrikam.com", "woodgrove.com"]
HOST_PREFIXES = ["desktop", "laptop", "server", "workstation"]
HUNTING_QUERIES = [
    "DeviceProcessEvents | where FileName == 'powershell.exe' | take 100",
    "SecurityAlert | where Severity == 'High' | sort by TimeGenerated desc",
    "DeviceLogonEvents | where ActionType == 'LogonFailed' | count",
    "IdentityLogonEvents | where Application == 'Office 365' | take 50",
]
TIME_RANGES = ["P1D", "P7D", "P30D", "PT1H", "PT24H"]

# Chat message formats. The prompt names a product, which is left
# to the caller; pass the product's name to get the exact text a model was
# trained with.
SYSTEM_PROMPT = (
    "You are a Security Operations AI Agent for {product}. "
    "Given the user request and the available tool definition, generate the "
    "correct JSON tool call for security analysis, incident response, or threat hunting."
)
DEFAULT_PRODUCT = "the security platform"
USER_MESSAGE = "User Request: {instruction}\nAvailable Tool: {tool}"

# Requests that end a session.
STOP_WORDS = ["quit", "exit", "q"]

# Routing rules in order, as (words, [(narrower words, tool key)],
# tool key when no narrower word is there).
ROUTES = [
    (
        ["alert", "alerts", "warning", "detection"],
        [(["update", "assign"], "update_alert"), (["get", "specific"], "get_alert")],
        "list_alerts",
    ),
    (
        ["incident", "incidents", "breach", "attack"],
        [(["get", "specific"], "get_incident")],
        "list_incidents",
    ),
    (["hunt", "hunting", "query", "kql"], [], "run_hunting_query"),
    (["score", "secure", "posture"], [], "list_secure_scores"),
    (["risky", "risk", "compromised"], [], "list_risky_users"),
    (["sign", "login", "authentication", "logon"], [], "list_sign_ins"),
    (["threat", "ioc", "indicator", "intelligence"], [], "list_ti_indicators"),
]
DEFAULT_ROUTE = "list_alerts"

# The tool catalogue, as tool key -> (function name, description,
# [(parameter, type, description)], required parameters or None). Two
# descriptions name a product; it is filled in like that of SYSTEM_PROMPT.
TOOLS = {
    "list_alerts": (
        "security_alerts_list",
        "List security alerts from {product}.",
        [
            ("$filter", "string", "OData filter (e.g., severity eq 'high')"),
            ("$select", "string", "Properties to select"),
            ("$top", "integer", "Number of results"),
            ("$orderby", "string", "Order by property"),
        ],
        None,
    ),
    "get_alert": (
        "security_alerts_get",
        "Get a specific security alert by ID.",
        [("alertId", "string", "The unique alert identifier")],
        ["alertId"],
    ),
    "update_alert": (
        "security_alerts_update",
        "Update a security alert (assign, change status, add comments).",
        [
            ("alertId", "string", "The unique alert identifier"),
            ("status", "string", "New status (new, inProgress, resolved)"),
            ("assignedTo", "string", "Analyst to assign the alert to"),
            (
                "classification",
                "string",
                "Classification (truePositive, falsePositive, benignPositive)",
            ),
            ("comments", "string", "Comments to add to the alert"),
        ],
        ["alertId"],
    ),
    "list_incidents": (
        "security_incidents_list",
        "List security incidents from {product}.",
        [
            ("$filter", "string", "OData filter (e.g., severity eq 'high')"),
            ("$top", "integer", "Number of results"),
            ("$orderby", "string", "Order by property"),
        ],
        None,
    ),
    "get_incident": (
        "security_incidents_get",
        "Get a specific security incident with all related alerts.",
        [
            ("incidentId", "string", "The unique incident identifier"),
            ("$expand", "string", "Related entities to expand (e.g., alerts)"),
        ],
        ["incidentId"],
    ),
    "run_hunting_query": (
        "security_runHuntingQuery",
        "Run an advanced hunting query using Kusto Query Language (KQL).",
        [
            (
                "query",
                "string",
                "KQL query to execute (e.g., DeviceProcessEvents | take 100)",
            ),
            ("timespan", "string", "Time range for the query (e.g., P7D for 7 days)"),
        ],
        ["query"],
    ),
    "list_secure_scores": (
        "security_secureScores_list",
        "Get the organization's security secure scores.",
        [("$top", "integer", "Number of results")],
        None,
    ),
    "list_risky_users": (
        "riskyUsers_list",
        "List users flagged as risky by Identity Protection.",
        [
            ("$filter", "string", "OData filter (e.g., riskLevel eq 'high')"),
            ("$top", "integer", "Number of results"),
        ],
        None,
    ),
    "list_sign_ins": (
        "signIns_list",
        "Get sign-in logs for security analysis.",
        [
            ("$filter", "string", "OData filter for sign-ins"),
            ("$top", "integer", "Number of results"),
            ("$orderby", "string", "Order by property"),
        ],
        None,
    ),
    "list_ti_indicators": (
        "security_tiIndicators_list",
        "List threat intelligence indicators.",
        [
            ("$filter", "string", "OData filter for indicators"),
            ("$top", "integer", "Number of results"),
        ],
        None,
    ),
}

# Defaults of the evaluation and training settings.
MAX_SEQ_LENGTH = 2048
TEST_SIZE = 0.1
SPLIT_SEED = 42
MAX_NEW_TOKENS = 256
TEMPERATURE = 0.1

# The layout of the readable metrics block.
METRICS_BLOCK = (
    "\n{thick}\n"
    "EVALUATION METRICS\n"
    "{thick}\n"
    "Total Samples:        %d\n"
    "{thin}\n"
    "JSON Validity Rate:   %s (%d/%d)\n"
    "Tool Name Accuracy:   %s (%d/%d)\n"
    "Argument Accuracy:    %s (%d/%d)\n"
    "{thin}\n"
    "Overall Accuracy:     %s\n"
    "{thin}\n"
    "Avg Inference Time:   %ss\n"
    "Tokens/Second:        %s\n"
    "Total Errors:         %d\n"
    "{thick}\n"
).format(thick="=" * 60, thin="─" * 60)
