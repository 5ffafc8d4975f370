"""DataFrame -> DataFrame operators, used by batch and streaming jobs alike."""
