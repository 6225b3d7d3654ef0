"""Field names recognised in uploaded records."""

from __future__ import annotations

# Aliases tried in order when a record is normalized automatically.
AUTOMATIC = {
    "timestamp": (
        "timestamp", "time", "event_time", "eventTime", "activityDateTime", "published",
        "createdDateTime", "observed_at", "datetime",
    ),
    "source_system": ("source_system", "source", "system", "log_source", "product"),
    "event_type": (
        "event_type", "type", "eventName", "event_name", "operation", "request_category",
        "alert_type", "category",
    ),
    "username": ("username", "user", "user_name", "actor", "account", "principal", "src_user"),
    "source_ip": ("source_ip", "src_ip", "client_ip", "remote_ip", "ip", "sourceAddress"),
    "destination_ip": (
        "destination_ip", "dest_ip", "dst_ip", "assigned_private_ip", "server_ip",
    ),
    "asset": (
        "asset", "host", "hostname", "device_name", "device", "target_resource", "resource",
    ),
    "http_method": ("http_method", "method"),
    "path": ("path", "url", "endpoint"),
    "action": ("action", "operation", "activity", "event_action"),
    "outcome": ("outcome", "result", "status", "status_code", "response_code"),
    "severity": ("severity", "level", "risk", "priority"),
    "mitre_technique_id": ("mitre_technique_id", "technique_id", "mitre", "technique"),
    "message": ("message", "reason", "description", "details", "alert"),
    "service": ("service",),
}

# Source system assumed for each declared source type.
SOURCE_SYSTEM_DEFAULTS = {
    "auth": "CLOUD-IAM",
    "vpn": "vpn",
    "cloud": "cloud_identity",
    "api": "api_gateway",
    "endpoint": "endpoint-edr",
    "generic": "uploaded_generic",
}

# Names that suggest a target field when a schema is inspected, targets in order.
SUGGESTED = {
    "timestamp": (
        "timestamp", "time", "event_time", "eventTime", "activityDateTime", "published",
        "createdDateTime", "observed_at", "datetime",
    ),
    "source_system": (
        "source_system", "source", "system", "log_source", "product", "eventSource", "service",
        "appDisplayName",
    ),
    "event_type": (
        "event_type", "type", "event_name", "request_category", "alert_type", "category",
        "riskEventType",
    ),
    "username": (
        "username", "user", "user_name", "account", "actor", "userPrincipalName", "principal",
        "src_user", "actor.alternateId", "userIdentity.userName",
    ),
    "source_ip": (
        "source_ip", "src_ip", "client_ip", "ipAddress", "sourceIPAddress", "client.ipAddress",
        "remote_ip", "ip", "sourceAddress",
    ),
    "destination_ip": (
        "destination_ip", "dest_ip", "dst_ip", "target_ip", "assigned_private_ip", "server_ip",
    ),
    "asset": (
        "asset", "host", "hostname", "device", "computer", "device_name", "device.hostname",
        "deviceDetail.displayName", "target_resource", "resource",
    ),
    "action": (
        "action", "operation", "operationName", "activity", "eventName", "event_action",
    ),
    "outcome": (
        "outcome", "result", "status", "status_code", "response_code", "errorCode",
        "status.errorCode", "status.failureReason",
    ),
    "severity": ("severity", "level", "risk", "priority", "riskLevelDuringSignIn"),
    "mitre_technique_id": ("mitre_technique_id", "technique_id", "mitre", "technique"),
    "message": ("message", "reason", "description", "details", "alert", "failureReason"),
}
