"""Error categories, retry delays and their topics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

AUTH, TRANSIENT, PERMANENT, CIRCUIT_OPEN, UNKNOWN = "auth", "transient", "permanent", "circuit_open", "unknown"

#: Marks in error texts and their categories; the first group that matches decides. Fixed values.
TEXT_MARKS = (
    (TRANSIENT, ("commitfailederror", "failed to commit transaction", "transaction conflict", "version conflict", "concurrent modification")),
    (TRANSIENT, ("connectionerror", "connection refused", "connection reset", "connection aborted", "no route to host", "network unreachable", "name resolution", "dns", "socket", "broken pipe")),
    (TRANSIENT, ("timeout",)),
    (AUTH, ("302", "401", "unauthorized", "authentication", "token expired", "invalid token")),
    (TRANSIENT, ("429", "throttl", "rate limit")),
    (TRANSIENT, ("503", "502", "504")),
    (PERMANENT, ("403", "forbidden", "access denied")),
    (PERMANENT, ("404", "not found")),
)
#: Marks of an expired or refused link, and codes of services with their categories. Fixed values.
EXPIRY_MARKS = ("403", "forbidden", "expired", "access denied", "unauthorized")
SERVICE_CODES = {
    "AADSTS50058": "auth", "AADSTS50079": "auth", "AADSTS50076": "auth", "AADSTS70008": "auth", "AADSTS700016": "auth",
    "AADSTS700082": "auth", "AADSTS7000215": "auth", "AADSTS7000222": "auth", "AADSTS90002": "auth",
    "AADSTS50196": "throttling", "AADSTS90015": "throttling",
    "AADSTS50001": "transient", "AADSTS90033": "transient", "AADSTS90019": "transient",
    "InternalError": "transient", "OperationTimedOut": "timeout", "ServerBusy": "throttling", "ServiceUnavailable": "transient",
    "AuthenticationFailed": "auth", "AccountIsDisabled": "permanent", "InsufficientAccountPermissions": "auth",
    "ContainerNotFound": "permanent", "BlobNotFound": "permanent",
    "40501": "throttling", "40613": "transient", "49918": "throttling", "10054": "connection", "40197": "transient", "40540": "transient",
    "401": "auth", "429": "throttling", "502": "transient", "503": "transient", "504": "transient", "403": "permanent", "404": "permanent",
}

#: Names of broker errors and their categories. Fixed values.
BROKER_ERRORS = {
    "transient": (
        "BrokerNotAvailableError", "KafkaConnectionError", "NodeNotReadyError", "LeaderNotAvailableError", "NotLeaderForPartitionError",
        "RequestTimedOutError", "KafkaTimeoutError", "NetworkException", "CorrelationIdError", "BrokerResponseError",
    ),
    "auth": ("TopicAuthorizationFailedError", "GroupAuthorizationFailedError", "ClusterAuthorizationFailedError", "SaslAuthenticationError"),
    "permanent": (
        "UnknownTopicOrPartitionError", "MessageSizeTooLargeError", "RecordTooLargeError", "InvalidTopicError", "InvalidConfigurationError", "UnsupportedVersionError",
        "IllegalStateError", "OffsetOutOfRangeError", "InvalidReplicationFactorError", "InvalidPartitionsError", "RecordBatchTooLargeError",
    ),
    "throttling": ("KafkaThrottlingError", "ProducerFencedException"),
}
#: Marks in broker messages whose error has no known name, by side; the first group that matches decides. Fixed values.
BROKER_MARKS = {
    "consumer": (("auth", ("unauthorized", "authentication", "authorization")), ("timeout", ("timeout",)), ("connection", ("connection", "broker", "network", "node not ready"))),
    "producer": (("auth", ("unauthorized", "authentication", "authorization")), ("timeout", ("timeout",)), ("connection", ("connection", "broker", "network", "leader"))),
}
#: Marks in messages of stores, by store; the first group that matches decides. Fixed values.
STORE_MARKS = {
    "kusto": (("auth", ("401", "unauthorized", "access rights")), ("throttling", ("429", "throttl", "too many requests")), ("timeout", ("timeout",)), ("transient", ("503", "502", "504", "service unavailable"))),
    "delta": (("auth", ("401", "unauthorized", "token")), ("throttling", ("429", "throttl")), ("timeout", ("timeout",)), ("connection", ("connection", "network", "dns")), ("transient", ("503", "502", "504"))),
    "onelake": (
        ("auth", ("401", "unauthorized", "authentication", "token expired")), ("throttling", ("429", "throttl")), ("timeout", ("timeout",)), ("connection", ("connection", "network", "dns", "socket")),
        ("transient", ("503", "502", "504", "service unavailable")), ("permanent", ("404", "not found")), ("permanent", ("403", "forbidden")),
    ),
}
#: Bytes above which a file is streamed. Fixed value.
STREAM_BYTES = 52_428_800


def _holds(text: Column, marks: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for m in marks:
        out = out | text.contains(m)
    return out


def of_text(message: Column) -> Column:
    """The category that an error text shows."""
    low, out = F.lower(F.coalesce(message, F.lit(""))), None
    for category, marks in TEXT_MARKS:
        out = F.when(_holds(low, marks), category) if out is None else out.when(_holds(low, marks), category)
    return out.otherwise(UNKNOWN)


def of_http(status: Column) -> Column:
    """The category of an HTTP status; success is unknown, being no error."""
    return (
        F.when(status.between(200, 299), UNKNOWN)
        .when(status.isin(302, 401), AUTH)
        .when(status == 429, TRANSIENT)
        .when(status.between(400, 499), PERMANENT)
        .when(status >= 500, TRANSIENT)
        .otherwise(UNKNOWN)
    )


def of_api(status: Column) -> Column:
    """struct<category, retryable> of an API status: authentication fails for good, other oddities are transient."""
    category = F.when(status == 401, AUTH).when(status == 429, TRANSIENT).when(status.between(400, 499), PERMANENT).otherwise(TRANSIENT)
    return F.struct(category.alias("category"), (category == TRANSIENT).alias("retryable"))


def of_code(code: Column) -> Column:
    """The category of a service's error code, null if unknown."""
    known = F.create_map(*[F.lit(x) for pair in SERVICE_CODES.items() for x in pair])
    return F.try_element_at(known, F.trim(code.cast("string")))


def _first(low: Column, groups: tuple, rest: Column) -> Column:
    out = rest
    for category, marks in reversed(groups):
        out = F.when(_holds(low, marks), category).otherwise(out)
    return out


def of_broker_name(name: Column) -> Column:
    """The category of a broker error's name, null if unknown."""
    known = F.create_map(*[F.lit(x) for category, names in BROKER_ERRORS.items() for n in names for x in (n, category)])
    return F.try_element_at(known, name)


def of_broker(name: Column, message: Column, side: str) -> Column:
    """The kind of a broker error of a consumer or producer, by its name, else by its message: auth, throttling,
    permanent, validation, timeout, connection, transient, or kafka where nothing fits."""
    low, category = F.lower(F.coalesce(message, F.lit(""))), of_broker_name(name)
    transient = F.when(low.contains("timeout") | name.contains("KafkaTimeoutError"), "timeout").when(low.contains("connection") | name.contains("KafkaConnectionError"), "connection").otherwise(TRANSIENT)
    permanent = F.lit(PERMANENT)
    if side == "producer":
        no_topic = low.contains("topic") & low.contains("not")
        too_large = low.contains("message") & (low.contains("size") | low.contains("large"))
        permanent = F.when(~no_topic & ~too_large & low.contains("invalid"), "validation").otherwise(permanent)
    by_name = F.when(category == TRANSIENT, transient).when(category == PERMANENT, permanent).otherwise(category)
    return F.coalesce(by_name, _first(low, BROKER_MARKS[side], F.lit("kafka")))


def of_store(store: str, message: Column, name: Column | None = None) -> Column:
    """The kind of a store's error by its message; the store's own name where nothing fits."""
    low = F.lower(F.coalesce(message, F.lit("")))
    rest = F.lit(store)
    if store == "kusto" and name is not None:
        rest = F.when(name.contains("KustoServiceError") & (low.contains("semantic error") | low.contains("syntax error")), "query").otherwise(rest)
    return _first(low, STORE_MARKS[store], rest)


def should_stream(size: Column) -> Column:
    """Whether a file is streamed: it is large, or its size is unknown."""
    return size.isNull() | (size > STREAM_BYTES)


def elapsed_ms(since: Column, until: Column) -> Column:
    """Milliseconds between two times."""
    return F.unix_millis(until) - F.unix_millis(since)


def as_of(now: Column | None = None) -> tuple[Column, Column]:
    """Now and today; a given time stands for both, so that a run can be repeated."""
    at = F.current_timestamp() if now is None else now
    return at, F.to_date(at)


def is_retryable(category: Column) -> Column:
    return category.isin(TRANSIENT, AUTH, UNKNOWN)


def needs_new_link(message: Column, category: Column) -> Column:
    """Whether a failed download should get a new link first."""
    return category.isin(TRANSIENT, UNKNOWN) & _holds(F.lower(F.coalesce(message, F.lit(""))), EXPIRY_MARKS)


def backoff(base: float, attempt: Column, most: float, jitter: Column | None = None) -> Column:
    """Seconds before an attempt: doubled each time, at most `most`; jitter in [0, 1) moves the upper half."""
    full = F.least(F.lit(float(base)) * F.pow(F.lit(2.0), attempt), F.lit(float(most)))
    return full if jitter is None else full / 2 + jitter * full / 2


def retry_topic(pending: str, delay_seconds: int) -> str:
    return f"{pending}.retry.{delay_seconds // 60}m"


def level_topic(pending: str, delays: list[int], count: Column) -> Column:
    """The retry topic of the level after `count` retries, the last level from then on."""
    topics = F.array(*[F.lit(retry_topic(pending, d)) for d in delays])
    return F.element_at(topics, F.least(count.cast("int") + 1, F.lit(len(delays))))
