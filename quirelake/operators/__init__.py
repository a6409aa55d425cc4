"""Part of quirelake."""
