"""How settings of each kind of connector are named on the other side. No logic here.

A rule is (rule set, target, source keys by preference, more), where ``more`` may hold
``default``, ``required``, ``secret`` (the name a masked value is shown under), ``values`` (a value map), ``form`` (text around the value),
``part`` (``first`` of a comma list, ``before`` or ``after`` the first colon) and ``when`` (conditions on other settings: ``key`` is
filled, ``!key`` is not, ``key=text`` is equal, ``key~text`` holds the text). Of two rules for one target the first that has a value counts.
``url.*`` are the parts of ``connection.url``, ``mongodb.uri`` is put together from the hosts and the user.
"""

# Kind, parts of the class name in lower case, rule sets.
KINDS = [
    ("debezium-mysql", ["debezium", "mysql"], ["debezium", "debezium-mysql"]),
    ("debezium-postgres", ["debezium", "postgres"], ["debezium", "debezium-postgres"]),
    ("debezium-sqlserver", ["debezium", "sqlserver"], ["debezium", "debezium-sqlserver"]),
    ("debezium-mongo", ["debezium", "mongo"], ["debezium-mongo"]),
    ("redshift", ["redshift"], ["url", "redshift"]),
    ("jdbc-source", ["jdbc", "source"], ["url", "jdbc-source"]),
    ("jdbc-sink", ["jdbc", "sink"], ["url", "jdbc-sink"]),
    ("s3", ["s3"], ["s3"]),
    ("gcs", ["gcs"], ["gcs"]),
    ("azure-blob", ["azure", "blob"], ["azure-blob"]),
    ("file-source", ["filestream", "source"], ["file", "file-source"]),
    ("file-sink", ["filestream", "sink"], ["file", "file-sink"]),
    ("mongo-source", ["mongo", "source"], ["mongo", "mongo-source"]),
    ("mongo-sink", ["mongo", "sink"], ["mongo", "mongo-sink"]),
    ("elasticsearch", ["elasticsearch"], ["elasticsearch"]),
    ("cassandra", ["cassandra"], ["cassandra"]),
    ("dynamodb", ["dynamodb"], ["dynamodb"]),
    ("redis", ["redis"], ["redis"]),
    ("bigquery", ["bigquery"], ["bigquery"]),
    ("snowflake", ["snowflake"], ["snowflake"]),
    ("clickhouse", ["clickhouse"], ["clickhouse"]),
    ("splunk", ["splunk"], ["splunk"]),
    ("http", ["http", "sink"], ["http"]),
    ("kafka-source", ["mirror"], ["kafka", "kafka-source"]),
    ("kafka-source", ["kafkasource"], ["kafka", "kafka-source"]),
    ("kafka-sink", ["kafkasink"], ["kafka", "kafka-sink"]),
]

# Setting names, defaults and conditions.
RULES = [
    ("debezium", "host", ["database.hostname"], {"required": True}),
    ("debezium", "user", ["database.user"], {"required": True}),
    ("debezium", "database", ["database.dbname"], {"required": True}),
    ("debezium", "password", ["database.password"], {"secret": "password"}),
    ("debezium-mysql", "port", ["database.port"], {"default": "3306"}),
    ("debezium-mysql", "cdc.enabled", [], {"default": "true"}),
    ("debezium-mysql", "tables", ["table.include.list", "table.whitelist"], {}),
    ("debezium-mysql", "snapshot.mode", ["snapshot.mode"], {"values": "snapshot"}),
    ("debezium-mysql", "ssl.mode", ["database.ssl.mode"], {"values": "not_disabled"}),
    ("debezium-postgres", "port", ["database.port"], {"default": "5432"}),
    ("debezium-postgres", "sslmode", ["database.sslmode"], {"default": "prefer"}),
    ("debezium-postgres", "schema", ["schema.include.list"], {}),
    ("debezium-postgres", "table", ["table.include.list"], {}),
    ("debezium-postgres", "cdc.mode", [], {"default": "logrepl"}),
    ("debezium-postgres", "replication.slot.name", ["slot.name"], {}),
    ("debezium-postgres", "snapshot.mode", ["snapshot.mode"], {"values": "snapshot"}),
    ("debezium-sqlserver", "port", ["database.port"], {"default": "1433"}),
    ("debezium-sqlserver", "cdc.enabled", [], {"default": "true"}),
    ("debezium-sqlserver", "databases", ["database.names"], {}),
    ("debezium-sqlserver", "tables", ["table.include.list"], {}),
    ("debezium-sqlserver", "encrypt", ["database.encrypt"], {"values": "only_true"}),
    ("debezium-sqlserver", "trustServerCertificate", ["database.trustServerCertificate"],
     {"values": "flag", "default": "false", "when": ["database.encrypt=true"]}),
    ("debezium-mongo", "uri", ["mongodb.connection.string", "mongodb.uri"], {"required": True}),
    ("debezium-mongo", "database", ["database.include.list"], {}),
    ("debezium-mongo", "collection", ["collection.include.list"], {}),
    ("debezium-mongo", "cdc.enabled", [], {"default": "true"}),
    ("url", "host", ["url.host"], {"required": True}),
    ("url", "database", ["url.database"], {"required": True}),
    ("url", "user", ["url.user", "connection.user"], {}),
    ("url", "password", ["url.password", "connection.password"], {"secret": "password"}),
    ("url", "ssl", ["url.ssl"], {"when": ["!url.sslmode"]}),
    ("redshift", "port", ["url.port"], {"default": "5439"}),
    ("redshift", "s3.bucket", ["s3.bucket.name"], {}),
    ("redshift", "table", ["table.name"], {}),
    ("jdbc-source", "table", ["table.name"], {"when": ["!query"]}),
    ("jdbc-source", "tables", ["table.whitelist"], {"when": ["!query", "!table.name"]}),
    ("jdbc-source", "tables.exclude", ["table.blacklist"], {"when": ["!query", "!table.name", "!table.whitelist"]}),
    ("jdbc-source", "cdc.mode", ["mode"], {"values": "jdbc_mode", "default": "snapshot"}),
    ("jdbc-source", "incrementing.column", ["incrementing.column.name"], {"when": ["mode~incrementing"]}),
    ("jdbc-source", "timestamp.column", ["timestamp.column.name"], {"when": ["mode~timestamp"]}),
    ("jdbc-source", "snapshot.mode", [], {"default": "initial_only", "when": ["mode=bulk"]}),
    ("jdbc-source", "poll.interval", ["poll.interval.ms"], {"form": "{}ms"}),
    ("jdbc-source", "batch.size", ["batch.max.rows"], {}),
    ("jdbc-sink", "table.format", ["table.name.format"], {}),
    ("jdbc-sink", "table", ["topics"], {"part": "first", "when": ["!table.name.format"]}),
    ("jdbc-sink", "sdk.record.operation", ["insert.mode"], {"values": "insert_mode", "default": "upsert"}),
    ("jdbc-sink", "primary.key.mode", ["pk.mode"], {}),
    ("jdbc-sink", "primary.key.fields", ["pk.fields"], {"when": ["pk.mode"]}),
    ("jdbc-sink", "table.auto.create", ["auto.create"], {"values": "only_true"}),
    ("jdbc-sink", "table.auto.evolve", ["auto.evolve"], {"values": "only_true"}),
    ("s3", "aws.bucket", ["s3.bucket.name"], {"required": True}),
    ("s3", "aws.region", ["s3.region"], {"default": "us-east-1"}),
    ("s3", "aws.accessKeyId", ["aws.access.key.id"], {}),
    ("s3", "aws.secretAccessKey", ["aws.secret.access.key"], {"secret": "aws.secretAccessKey"}),
    ("s3", "path.prefix", ["topics.dir"], {}),
    ("s3", "format", ["format.class"], {"values": "file_format", "default": "json"}),
    ("s3", "partition.format", ["partitioner.class"], {"values": "partitioner"}),
    ("s3", "path.format", ["path.format"], {"when": ["partitioner.class~TimeBasedPartitioner"]}),
    ("s3", "partition.field", ["partition.field.name"], {"when": ["partitioner.class~FieldPartitioner"]}),
    ("s3", "buffer.size", ["flush.size"], {}),
    ("s3", "rotate.interval", ["rotate.interval.ms"], {"form": "{}ms"}),
    ("gcs", "bucket", ["gcs.bucket.name"], {"required": True}),
    ("gcs", "credentials.json", ["gcs.credentials.json"], {"secret": "credentials.json", "when": ["!gcs.credentials.path"]}),
    ("gcs", "path.prefix", ["topics.dir"], {}),
    ("gcs", "format", ["format.class"], {"values": "file_format", "default": "json"}),
    ("azure-blob", "container", ["azblob.container.name"], {"required": True}),
    ("azure-blob", "account", ["azblob.account.name"], {"required": True}),
    ("azure-blob", "account.key", ["azblob.account.key"], {"secret": "account.key"}),
    ("azure-blob", "sas.token", ["azblob.sas.token"], {"secret": "sas.token", "when": ["!azblob.account.key"]}),
    ("azure-blob", "path.prefix", ["topics.dir"], {}),
    ("file", "path", ["file"], {"required": True}),
    ("file-source", "tail", ["tail"], {"values": "only_true"}),
    ("file-sink", "rotate.interval", ["rotate.interval.ms"], {"form": "{}ms"}),
    ("mongo", "uri", ["connection.uri", "mongodb.connection.string"], {"required": True}),
    ("mongo-source", "snapshot", ["copy.existing"], {"values": "only_true"}),
    ("mongo-sink", "document.id.strategy", ["document.id.strategy"], {"values": "document_id"}),
    ("mongo-sink", "write.model", ["writemodel.strategy"], {"values": "write_model"}),
    ("mongo-sink", "upsert", ["mongodb.upsert"], {"values": "only_true"}),
    ("elasticsearch", "urls", ["connection.url", "elasticsearch.hosts"], {"required": True}),
    ("elasticsearch", "username", ["connection.username", "elasticsearch.username"], {}),
    ("elasticsearch", "password", ["connection.password", "elasticsearch.password"], {"secret": "password", "when": ["connection.username"]}),
    ("elasticsearch", "password", ["connection.password", "elasticsearch.password"], {"secret": "password", "when": ["elasticsearch.username"]}),
    ("elasticsearch", "index", ["topics"], {"part": "first"}),
    ("elasticsearch", "type", ["type.name"], {}),
    ("elasticsearch", "use.document.id", ["key.ignore"], {"values": "only_false"}),
    ("elasticsearch", "behavior.on.null", ["behavior.on.null.values"], {}),
    ("elasticsearch", "behavior.on.malformed", ["behavior.on.malformed.documents"], {}),
    ("elasticsearch", "bulk.size", ["batch.size"], {}),
    ("elasticsearch", "flush.timeout", ["flush.timeout.ms"], {"form": "{}ms"}),
    ("cassandra", "contact.points", ["cassandra.contact.points", "contact.points"], {"required": True}),
    ("cassandra", "port", ["cassandra.port"], {"default": "9042"}),
    ("cassandra", "keyspace", ["cassandra.keyspace", "keyspace"], {"required": True}),
    ("cassandra", "password", ["cassandra.password"], {"secret": "password", "when": ["cassandra.username"]}),
    ("cassandra", "table", ["cassandra.table", "table"], {}),
    ("cassandra", "ssl.enabled", ["cassandra.ssl.enabled"], {"values": "only_true"}),
    ("cassandra", "ssl.cert.path", ["cassandra.ssl.cert.path"], {"when": ["cassandra.ssl.enabled=true"]}),
    ("dynamodb", "aws.region", ["aws.region"], {"required": True}),
    ("dynamodb", "table", ["dynamodb.table.name", "table.name"], {"required": True}),
    ("dynamodb", "aws.accessKeyId", ["aws.access.key.id"], {}),
    ("dynamodb", "aws.secretAccessKey", ["aws.secret.access.key"], {"secret": "aws.secretAccessKey"}),
    ("dynamodb", "read.capacity", ["dynamodb.read.capacity.units"], {}),
    ("dynamodb", "write.capacity", ["dynamodb.write.capacity.units"], {}),
    ("redis", "host", ["redis.hosts", "redis.host"], {"required": True}),
    ("redis", "port", ["redis.port"], {"default": "6379"}),
    ("redis", "password", ["redis.password"], {"secret": "password"}),
    ("redis", "tls.enabled", ["redis.ssl.enabled"], {"values": "only_true"}),
    ("redis", "tls.cert.path", ["redis.ssl.cert.path"], {"when": ["redis.ssl.enabled=true"]}),
    ("bigquery", "project.id", ["project"], {"required": True}),
    ("bigquery", "dataset", ["datasets", "defaultDataset"], {"required": True}),
    ("bigquery", "credentials.path", ["keyfile"], {}),
    ("bigquery", "credentials.json", ["credentials"], {"secret": "credentials.json", "when": ["!keyfile"]}),
    ("bigquery", "table", ["table"], {}),
    ("bigquery", "table", ["topics"], {"part": "first"}),
    ("bigquery", "auto.create.tables", ["autoCreateTables"], {"values": "only_true"}),
    ("bigquery", "time.partitioning", ["timePartitioning"], {}),
    ("bigquery", "clustered.fields", ["clusteredFields"], {}),
    ("bigquery", "write.disposition", ["writeDisposition"], {}),
    ("bigquery", "batch.size", ["batchSize"], {}),
    ("snowflake", "account", ["snowflake.url.name", "snowflake.account"], {"required": True}),
    ("snowflake", "user", ["snowflake.user.name"], {"required": True}),
    ("snowflake", "password", ["snowflake.password"], {"required": True, "secret": "password"}),
    ("snowflake", "database", ["snowflake.database.name"], {"required": True}),
    ("snowflake", "schema", ["snowflake.schema.name"], {"required": True}),
    ("snowflake", "table", ["snowflake.table.name"], {}),
    ("snowflake", "role", ["snowflake.role.name"], {}),
    ("snowflake", "private.key", ["snowflake.private.key"], {"secret": "private.key"}),
    ("snowflake", "private.key.passphrase", ["snowflake.private.key.passphrase"],
     {"secret": "private.key.passphrase", "when": ["snowflake.private.key"]}),
    ("clickhouse", "host", ["hostname"], {"required": True}),
    ("clickhouse", "port", ["port"], {"default": "8123"}),
    ("clickhouse", "database", ["database"], {"required": True}),
    ("clickhouse", "password", ["password"], {"secret": "password", "when": ["username"]}),
    ("clickhouse", "ssl", ["ssl"], {"values": "only_true"}),
    ("clickhouse", "sslmode", ["sslmode"], {"when": ["ssl=true"]}),
    ("splunk", "url", ["splunk.hec.uri"], {"required": True}),
    ("splunk", "method", [], {"default": "POST"}),
    ("splunk", "headers.Authorization", ["splunk.hec.token"], {"secret": "hec.token", "form": "Splunk {}"}),
    ("splunk", "body.template.event", [], {"default": "{{.Payload}}"}),
    ("splunk", "body.template.index", ["splunk.indexes"], {}),
    ("splunk", "body.template.sourcetype", ["splunk.sourcetype"], {}),
    ("splunk", "body.template.source", ["splunk.source"], {}),
    ("splunk", "tls.skip.verify", ["splunk.hec.ack.enabled"], {"values": "only_false"}),
    ("splunk", "retry.max", ["splunk.hec.max.retries"], {}),
    ("http", "url", ["http.api.url", "url"], {"required": True}),
    ("http", "method", ["request.method"], {"default": "POST"}),
    ("http", "headers.Authorization", ["auth.bearer.token"], {"secret": "bearer.token", "form": "Bearer {}", "when": ["auth.type=BEARER"]}),
    ("http", "headers.*", ["headers.*"], {}),
    ("http", "auth.username", ["auth.user.info"], {"part": "before", "when": ["auth.type=BASIC"]}),
    ("http", "auth.password", ["auth.user.info"], {"part": "after", "secret": "auth.password", "when": ["auth.type=BASIC"]}),
    ("http", "oauth2.enabled", [], {"default": "true", "when": ["auth.type=OAUTH2"]}),
    ("http", "oauth2.token.url", ["oauth2.token.url"], {"when": ["auth.type=OAUTH2"]}),
    ("http", "oauth2.client.id", ["oauth2.client.id"], {"when": ["auth.type=OAUTH2"]}),
    ("http", "oauth2.client.secret", ["oauth2.client.secret"], {"secret": "oauth2.client.secret", "when": ["auth.type=OAUTH2"]}),
    ("http", "retry.max", ["max.retries"], {}),
    ("http", "retry.backoff", ["retry.backoff.ms"], {"form": "{}ms"}),
    ("http", "timeout", ["request.timeout.ms"], {"form": "{}ms"}),
    ("kafka", "brokers", ["bootstrap.servers", "source.cluster.bootstrap.servers", "kafka.bootstrap.servers"], {"required": True}),
    ("kafka", "topic.regex", ["topics.regex"], {"when": ["!topics"]}),
    ("kafka", "sasl.mechanism", ["sasl.mechanism"], {"when": ["security.protocol~SASL"]}),
    ("kafka", "sasl.jaas.config", ["sasl.jaas.config"], {"when": ["security.protocol~SASL"]}),
    ("kafka", "ssl.truststore.location", ["ssl.truststore.location"], {"when": ["security.protocol~SSL"]}),
    ("kafka", "ssl.truststore.password", ["ssl.truststore.password"], {"secret": "ssl.truststore.password", "when": ["security.protocol~SSL"]}),
    ("kafka-source", "topics", ["topics"], {"required": True, "when": ["!topics.regex"]}),
    ("kafka-source", "consumer.group.id", ["group.id"], {}),
    ("kafka-source", "consumer.offset.reset", ["consumer.auto.offset.reset"], {}),
    ("kafka-source", "key.deserializer", ["key.deserializer"], {"values": "serializer"}),
    ("kafka-source", "value.deserializer", ["value.deserializer"], {"values": "serializer"}),
    ("kafka-sink", "producer.compression", ["producer.compression.type"], {}),
    ("kafka-sink", "key.serializer", ["key.serializer"], {"values": "serializer"}),
    ("kafka-sink", "value.serializer", ["value.serializer"], {"values": "serializer"}),
]

# Settings that keep their name but for a prefix: rule set, prefix of the source key, names.
KEPT_NAMES = [
    ("debezium-mysql", "database.", ["server.id"]),
    ("debezium-postgres", "", ["publication.name"]),
    ("debezium-mongo", "", ["pipeline"]),
    ("url", "url.", ["port", "sslmode"]),
    ("redshift", "", ["s3.region"]),
    ("redshift", "aws.redshift.", ["iam.role"]),
    ("redshift", "redshift.", ["copy.options"]),
    ("jdbc-source", "", ["query"]),
    ("jdbc-sink", "", ["batch.size"]),
    ("gcs", "gcs.", ["project.id", "credentials.path"]),
    ("file", "", ["format"]),
    ("file-source", "", ["start.position"]),
    ("file-sink", "", ["rotate.size", "compression"]),
    ("mongo", "", ["database", "collection"]),
    ("mongo-source", "", ["pipeline", "batch.size", "full.document"]),
    ("mongo-sink", "max.", ["batch.size"]),
    ("elasticsearch", "", ["index", "max.in.flight.requests"]),
    ("cassandra", "cassandra.", ["username", "consistency.level", "local.datacenter"]),
    ("dynamodb", "dynamodb.", ["endpoint"]),
    ("dynamodb", "", ["batch.size"]),
    ("redis", "redis.", ["database", "key.prefix", "key.field", "ttl"]),
    ("snowflake", "snowflake.", ["warehouse"]),
    ("clickhouse", "", ["username", "table", "batch.size"]),
    ("clickhouse", "clickhouse.", ["engine"]),
    ("splunk", "", ["batch.size"]),
    ("http", "", ["batch.size"]),
    ("kafka", "", ["topics", "security.protocol"]),
    ("kafka-sink", "", ["producer.acks"]),
]

# Value map, pattern, result. ``=`` compares whole values, ``~`` looks for the text in any case; the first that fits counts, a
# result of None leaves the setting out, and a value that nothing fits stays.
VALUE_MAPS = [
    ("only_true", "=true", "true"), ("only_true", "~", None),
    ("only_false", "=false", "true"), ("only_false", "~", None),
    ("flag", "=true", "true"), ("flag", "~", "false"),
    ("not_disabled", "=disabled", None),
    ("snapshot", "=initial", "initial"), ("snapshot", "=never", "never"), ("snapshot", "=initial_only", "initial_only"),
    ("snapshot", "=when_needed", "when_needed"), ("snapshot", "=always", "always"), ("snapshot", "~", "initial"),
    ("jdbc_mode", "=incrementing", "auto_incrementing"), ("jdbc_mode", "=timestamp", "timestamp"),
    ("jdbc_mode", "=timestamp+incrementing", "timestamp_incrementing"), ("jdbc_mode", "~", "snapshot"),
    ("insert_mode", "=insert", "create"), ("insert_mode", "=update", "update"), ("insert_mode", "~", "upsert"),
    ("file_format", "~json", "json"), ("file_format", "~avro", "avro"), ("file_format", "~parquet", "parquet"), ("file_format", "~", "json"),
    ("partitioner", "~TimeBasedPartitioner", "time"), ("partitioner", "~FieldPartitioner", "field"), ("partitioner", "~", None),
    ("serializer", "~ByteArray", "bytes"), ("serializer", "~String", "string"), ("serializer", "~Json", "json"),
    ("serializer", "~Avro", "avro"), ("serializer", "~", "bytes"),
    ("document_id", "~BsonOidStrategy", "bson_oid"), ("document_id", "~UuidStrategy", "uuid"),
    ("document_id", "~ProvidedInKeyStrategy", "provided_in_key"), ("document_id", "~ProvidedInValueStrategy", "provided_in_value"),
    ("document_id", "~PartialKeyStrategy", "partial_key"), ("document_id", "~PartialValueStrategy", "partial_value"),
    ("document_id", "~", "bson_oid"),
    ("write_model", "~ReplaceOneDefaultStrategy", "replace_one"), ("write_model", "~ReplaceOneBusinessKeyStrategy", "replace_one_business_key"),
    ("write_model", "~DeleteOneDefaultStrategy", "delete_one"), ("write_model", "~UpdateOneTimestampsStrategy", "update_one_timestamps"),
    ("write_model", "~InsertOneDefaultStrategy", "insert_one"), ("write_model", "~", "replace_one"),
]
