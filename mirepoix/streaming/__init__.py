"""The row-wise operators over file streams."""
