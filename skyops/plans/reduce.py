"""Image reduction: masters, calibration, crop, stack, statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyops.operators import images
from skyops.session import cut_lineage

KINDS = ("bias", "dark", "flat", "light")


def reduce_and_stack(frames: DataFrame, method: str = "sigma_clip", stack: str = "field",
                     dark_exptime: float | None = None) -> dict[str, DataFrame]:
    """Frames (frame_id, imagetyp, ``stack``, exptime, y0, x0, h, w, px) to combined images.

    Which kinds there are comes from one small query (pixel arrays are not read for it).
    Masters are single images; they are stored once, since every science pixel meets them.
    """
    kinds = {r[0] for r in frames.select("imagetyp").where(F.col("imagetyp").isin(*KINDS)).distinct().collect()}
    pixels = {k: images.to_pixels(frames.filter(F.col("imagetyp") == k),
                                  ("frame_id", stack, "exptime")) for k in KINDS}
    bias = dark = flat = None
    most = images.stack_depth(frames, ["imagetyp"], least=1)
    if "bias" in kinds:
        bias = cut_lineage(images.master_bias(pixels["bias"], most))
    if "dark" in kinds:
        dark = cut_lineage(images.master_dark(pixels["dark"], bias, most))
    if "flat" in kinds:
        flat = cut_lineage(images.master_flat(pixels["flat"], bias, dark, most))
    light = images.calibrate(pixels["light"], bias, dark, flat, dark_exptime, normalized=True)
    lights = frames.filter(F.col("imagetyp") == "light")
    aligned = images.align_crop(light, images.shapes(lights, [stack, "frame_id"]), [stack])
    depth = images.stack_depths(lights, [stack]).filter(F.col("frames") >= 2)
    ready = aligned.join(depth.select(stack), stack, "left_semi")
    combined = images.combine_pixels(ready, [stack], method, depth=most)  # a stack is no deeper than its kind
    return {"bias": bias, "dark": dark, "flat": flat, "calibrated": light,
            "stack": combined, "stats": images.image_stats(combined, [stack])}
