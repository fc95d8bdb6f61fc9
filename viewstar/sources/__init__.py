"""Sources: the driver-table adapter, message decoding inputs, Kafka and
file stream sources, and the warehouse reader."""
