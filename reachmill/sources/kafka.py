"""Sale events from a Kafka endpoint with SASL log-in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Port, security protocol and log-in name of the broker endpoint.
PORT = 9093
SECURITY = {"kafka.security.protocol": "SASL_SSL", "kafka.sasl.mechanism": "PLAIN"}
LOGIN_USER = "$ConnectionString"
LOGIN_MODULE = "org.apache.kafka.common.security.plain.PlainLoginModule"
# some distributions ship the Kafka client under another package
SHADED_LOGIN_MODULE = f"kafkashaded.{LOGIN_MODULE}"


def kafka_options(
    connection_string: str,
    namespace: str,
    topic: str | None,
    configured_topic: str | None = None,
    login_module: str = LOGIN_MODULE,
    max_offsets_per_trigger: int | None = None,
    fail_on_data_loss: bool = False,
) -> dict[str, str]:
    """Reader options. A topic from configuration wins over the argument.

    By default messages that the broker no longer has are passed over; with
    fail_on_data_loss the stream ends instead.
    """
    subscribe = configured_topic or topic
    if not subscribe:
        raise ValueError("no topic given, neither as argument nor in the configuration")
    options = {
        "kafka.bootstrap.servers": f"{namespace}:{PORT}",
        "subscribe": subscribe,
        **SECURITY,
        "kafka.sasl.jaas.config": (
            f"{login_module} required"
            f' username="{LOGIN_USER}" password="{connection_string}";'
        ),
        "startingOffsets": "earliest",  # fixed value
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def stream_messages(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.readStream.format("kafka").options(**options).load()
