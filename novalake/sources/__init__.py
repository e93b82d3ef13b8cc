"""Landing files, manifests, payloads and the tables of the lake."""
