"""Customer features, segmentation and the experimental quantity model."""
