"""Pure DataFrame -> DataFrame operators; none of them writes."""
