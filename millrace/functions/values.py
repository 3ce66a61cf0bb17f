"""Word lists, class names and tables that results depend on. No logic here."""

# Keys of a connector document that are lifted out of its settings.
HEAD_KEYS = ("name", "connector.class", "class", "tasks.max", "topics", "topics.regex",
             "key.converter", "value.converter", "header.converter", "transforms")

# Parts of a key name that mark its value as sensitive.
SENSITIVE_PARTS = ("password", "passwd", "pwd", "secret", "key", "token", "credential", "auth", "private", "cert")

# Key prefixes and keys that only the old runtime understands.
RUNTIME_PREFIXES = ("connector.", "tasks.", "transforms.", "key.converter", "value.converter", "header.converter",
                    "config.action.reload", "errors.", "topic.creation.")
RUNTIME_KEYS = ("name", "class")

# Class-name parts that tell the direction of a connector when neither source nor sink occurs.
SOURCE_PARTS = ("debezium", "cdc", "reader", "consumer", "poll")
DESTINATION_PARTS = ("writer", "producer", "exporter", "publisher")

# JDBC protocol -> database family.
DATABASE_FAMILIES = {"postgresql": "postgres", "mysql": "mysql", "mariadb": "mysql", "sqlserver": "sqlserver",
                     "microsoft:sqlserver": "sqlserver", "oracle": "oracle", "sqlite": "sqlite"}

STATUSES = ("supported", "partial", "manual", "unsupported")

# Minutes of human work per record and per step, by status.
RECORD_MINUTES = {"supported": 30, "partial": 90, "manual": 240, "unsupported": 480}
OTHER_RECORD_MINUTES = 120
STEP_MINUTES = {"supported": 15, "partial": 45}
OTHER_STEP_MINUTES = 120

# Allowed words of a pipeline document.
PIPELINE_STATUSES = ("running", "paused", "stopped")
STAGE_TYPES = ("source", "destination")
PLUGIN_KINDS = ("builtin", "standalone", "custom")

# Catalog categories (key, name, description).
CATEGORIES = [
    ("databases", "Database Connectors", "Relational and NoSQL database connectors"),
    ("messaging", "Messaging & Streaming", "Message brokers and streaming platforms"),
    ("storage", "Cloud Storage", "Object storage and file systems"),
    ("search", "Search & Analytics", "Search engines and analytics platforms"),
    ("monitoring", "Monitoring & Observability", "Logging, metrics, and monitoring systems"),
]

# The default catalog, one public connector class per entry.
# class, name, category, equivalent, type, status, confidence, effort, required keys, unsupported features
CATALOG = [
    ("io.debezium.connector.mysql.MySqlConnector", "MySQL CDC (Debezium)", "databases", "mysql-cdc", "source",
     "supported", "high", "30 minutes",
     ["database.hostname", "database.port", "database.user", "database.password", "database.server.name"],
     ["database.ssl.mode=VERIFY_IDENTITY", "signal.data.collection"]),
    ("io.debezium.connector.postgresql.PostgresConnector", "PostgreSQL CDC (Debezium)", "databases", "postgres-cdc",
     "source", "supported", "high", "30 minutes",
     ["database.hostname", "database.port", "database.user", "database.password", "database.dbname",
      "database.server.name"],
     ["slot.drop.on.stop=false"]),
    ("io.confluent.connect.jdbc.JdbcSourceConnector", "JDBC Source", "databases", "postgres", "source",
     "supported", "high", "45 minutes", ["connection.url", "mode"], ["validate.non.null=false"]),
    ("io.confluent.connect.jdbc.JdbcSinkConnector", "JDBC Sink", "databases", "postgres", "destination",
     "supported", "high", "30 minutes", ["connection.url"], []),
    ("io.confluent.connect.s3.S3SinkConnector", "Amazon S3 Sink", "storage", "s3", "destination",
     "supported", "high", "30 minutes", ["s3.bucket.name"],
     ["storage.class=io.confluent.connect.s3.storage.S3Storage"]),
    ("org.apache.kafka.connect.file.FileStreamSourceConnector", "File Stream Source", "storage", "file", "source",
     "supported", "high", "15 minutes", ["file"], []),
    ("org.apache.kafka.connect.file.FileStreamSinkConnector", "File Stream Sink", "storage", "file", "destination",
     "supported", "high", "15 minutes", ["file"], []),
    ("io.confluent.connect.elasticsearch.ElasticsearchSinkConnector", "Elasticsearch Sink", "search",
     "elasticsearch", "destination", "supported", "high", "30 minutes", ["connection.url"], []),
    ("org.apache.kafka.connect.mirror.MirrorSourceConnector", "Kafka Source (MirrorMaker)", "messaging", "kafka",
     "source", "partial", "medium", "2-3 hours", ["source.cluster.bootstrap.servers"],
     ["sync.group.offsets.enabled=true"]),
    ("io.confluent.connect.http.HttpSinkConnector", "HTTP Sink", "messaging", "http", "destination",
     "supported", "high", "30 minutes", ["http.api.url"], []),
    ("com.mongodb.kafka.connect.MongoSourceConnector", "MongoDB Source", "databases", "mongo", "source",
     "partial", "medium", "1-2 hours", ["connection.uri"], ["copy.existing=true"]),
    ("com.mongodb.kafka.connect.MongoSinkConnector", "MongoDB Sink", "databases", "mongo", "destination",
     "supported", "high", "30 minutes", ["connection.uri"], []),
    ("com.clickhouse.kafka.connect.ClickHouseSinkConnector", "ClickHouse Sink", "databases", "clickhouse",
     "destination", "supported", "high", "45 minutes", [], []),
    ("com.wepay.kafka.connect.bigquery.BigQuerySinkConnector", "Google BigQuery Sink", "databases", "bigquery",
     "destination", "supported", "high", "45 minutes", [], []),
    ("io.confluent.connect.aws.redshift.RedshiftSinkConnector", "Amazon Redshift Sink", "databases", "redshift",
     "destination", "supported", "high", "45 minutes", [], []),
    ("com.snowflake.kafka.connector.SnowflakeSinkConnector", "Snowflake Sink", "databases", "snowflake",
     "destination", "supported", "high", "45 minutes", [], []),
    ("com.github.castorm.kafka.connect.http.HttpSinkConnector", "Webhook Sink", "messaging", "webhook",
     "destination", "supported", "high", "30 minutes", [], []),
    ("io.confluent.connect.slack.SlackSinkConnector", "Slack Sink", "messaging", "slack", "destination",
     "supported", "high", "20 minutes", [], []),
    ("io.nats.connect.NatsSourceConnector", "NATS Source", "messaging", "nats", "source",
     "supported", "high", "30 minutes", [], []),
    ("io.nats.connect.NatsSinkConnector", "NATS Sink", "messaging", "nats", "destination",
     "supported", "high", "30 minutes", [], []),
    ("org.opensearch.connector.opensearch.OpenSearchSinkConnector", "OpenSearch Sink", "search", "opensearch",
     "destination", "supported", "high", "30 minutes", [], []),
    ("com.github.jcustenborder.kafka.connect.syslog.UdpSyslogSourceConnector", "Syslog Source", "monitoring", "log",
     "source", "supported", "medium", "45 minutes", [], []),
]

# Known step classes, their equivalent where one is named, and status.
STEP_CATALOG = [
    ("org.apache.kafka.connect.transforms.RegexRouter", "field.rename", "supported"),
    ("org.apache.kafka.connect.transforms.TimestampConverter", "field.convert", "supported"),
    ("org.apache.kafka.connect.transforms.InsertField", "field.set", "supported"),
    ("org.apache.kafka.connect.transforms.ReplaceField", None, "supported"),
    ("org.apache.kafka.connect.transforms.MaskField", "field.mask", "supported"),
    ("org.apache.kafka.connect.transforms.Filter", "filter.field", "supported"),
    ("org.apache.kafka.connect.transforms.Cast", None, "supported"),
    ("org.apache.kafka.connect.transforms.ExtractField", None, "supported"),
    ("org.apache.kafka.connect.transforms.Flatten", None, "supported"),
    ("io.debezium.transforms.ExtractNewRecordState", "unwrap.debezium", "supported"),
    ("io.debezium.transforms.ByLogicalTableRouter", None, "partial"),
]

# Settings a plugin needs and may have (plugin, required, optional).
CAPABILITIES = [
    ("builtin:postgres", ["host", "database", "user"], ["port", "password", "sslmode", "schema", "table"]),
    ("builtin:mysql", ["host", "database", "user"], ["port", "password", "ssl-mode", "server-id"]),
    ("builtin:kafka", ["brokers", "topics"], ["consumer.group.id", "tls.enabled", "sasl.mechanism"]),
    ("builtin:s3", ["aws.bucket"], ["aws.region", "aws.accessKeyId", "aws.secretAccessKey", "path.prefix"]),
    ("builtin:http", ["url"], ["method", "headers", "timeout", "retry.max"]),
]
