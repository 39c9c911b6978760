"""Writers; none of them brings rows to the driver."""
