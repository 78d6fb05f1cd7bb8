"""Sources: files, logs, images, archives and services as DataFrames."""
