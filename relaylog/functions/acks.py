"""Acknowledgement bodies and response classification."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from relaylog.functions import jsontext as J

MAX_RESPONSE_BYTES = 64 << 10

# Why a response is a retry.
INVALID_ACK = "invalid acknowledgement"
RETRY_REQUESTED = "destination requested retry"
TOO_LARGE = "destination response exceeds 64 KiB"


def _members_named(members: Column, name: str) -> Column:
    """Values of the members with this name in any letter case."""
    return F.map_values(F.map_filter(members, lambda k, _: F.lower(k) == name + J.MARK))


def decode_ack(body: Column) -> Column:
    """``success``, ``keep_going``, ``retry`` (asked for) or null (not a valid acknowledgement, so a retry).

    ``result``, ``policy``, ``class`` and ``description`` are found in any letter case; ``success`` and
    ``error`` only as written. Several ``result`` members make the body invalid.
    """

    def of_results(results: Column) -> Column:
        result = J.as_object(F.when(F.size(results) == 1, F.get(results, F.lit(0))))
        return J.bind(J.parse_members(result, ["success", "error"]), of_result)

    def of_result(result: Column) -> Column:
        policy = J.bind(J.member_map(J.as_object(J.member(result, "error"))), _policy)
        return F.when(J.is_object(J.member(result, "success")), "success").otherwise(policy)

    return J.bind(_members_named(J.members_of(body), "result"), of_results)


def _policy(error: Column) -> Column:
    """What a complete error object asks for."""

    def text(values: Column) -> Column:
        well_typed = F.forall(values, lambda v: J.is_string(v) | J.is_null(v))
        return F.when(well_typed, J.string_or_null(F.get(values, F.size(values) - 1)))

    policy, kind, description = (J.bind(_members_named(error, n), text) for n in ("policy", "class", "description"))
    complete = kind.isNotNull() & description.isNotNull()
    return F.when(complete & (policy == "keep_going"), "keep_going").when(complete & (policy == "must_retry"), "retry")


def classify_response(status: Column, body: Column) -> Column:
    """struct(outcome, retry_reason): outcome ``delivered`` or ``skipped``, else null with a reason."""
    too_large = F.octet_length(body) > MAX_RESPONSE_BYTES
    refused = ~status.between(200, 299)
    ack = F.when(~too_large & ~refused, decode_ack(body))

    def classified(ack: Column) -> Column:
        reason = (
            F.when(status.isNull(), "destination unreachable")
            .when(too_large, TOO_LARGE)
            .when(refused, F.concat(F.lit("destination returned HTTP "), status.cast("string")))
            .when(ack.isNull(), INVALID_ACK)
            .when(ack == "retry", RETRY_REQUESTED)
        )
        outcome = F.when(ack == "success", "delivered").when(ack == "keep_going", "skipped")
        return F.struct(outcome.alias("outcome"), reason.alias("retry_reason"))

    return J.bind(ack, classified)
