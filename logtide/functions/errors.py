"""Which failures are worth another try."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names of exceptions and error codes.
THROTTLING = ("KmsThrottlingException", "ProvisionedThroughputExceededException", "LimitExceededException")
RECOVERABLE_CODES = ("ProvisionedThroughputExceededException", "InternalFailure", "ServiceUnavailable")
RECOVERABLE = ("ReadTimeoutException", "IOException", "ResourceInUseException")


def is_throttling(name: Column) -> Column:
    return F.coalesce(name.isin(*THROTTLING), F.lit(False))


def is_recoverable(name: Column, status: Column, cause: Column) -> Column:
    """A service error that isn't the caller's (status not 4xx), a time-out, input or output, a resource in use, or a wrapper of one."""
    own = (status.isNotNull() & (F.floor(status / 100) != 4)) | F.coalesce(name.isin(*RECOVERABLE), F.lit(False))
    return own | ((name == "SdkException") & F.coalesce(cause.isin(*RECOVERABLE), F.lit(False)))


def entry_outcome(error_code: Column) -> Column:
    """ok, retry or failed, for one entry of a response."""
    return F.when(error_code.isNull(), "ok").when(error_code.isin(*RECOVERABLE_CODES), "retry").otherwise("failed")
