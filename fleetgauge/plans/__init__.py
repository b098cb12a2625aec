"""Report, metric and digest datasets."""
