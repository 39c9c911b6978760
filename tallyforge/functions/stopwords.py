"""The default Vietnamese stopword list."""

# The stopword list in the order supplied, repeats included. The entries
# of two words never equal a single token.
_LISTED = """
là, của, và, có, được, bị, đã, đang, sẽ, từng, cũng, vẫn, còn, lại, rất, khá, hơi, quá,
tôi, ta, tao, mày, bạn, anh, chị, em, ông, bà, họ, chúng, chúng tôi, chúng ta, chúng nó,
nó, một, hai, ba, vài, nhiều, ít, mọi, mỗi, từng, các, những, cái, này, kia, đó, ấy,
trong, ngoài, trên, dưới, giữa, bên, cạnh, với, theo, cho, về, từ, đến, tại, bởi, vì,
do, nên, nếu, thì, mà, nhưng, hoặc, ai, gì, nào, sao, tại sao, bao giờ, bao lâu, bao
nhiêu, đâu, chăng, à, ư, hả, nhỉ, nhé, có thể, cần, phải, nên, muốn, định, đang, được,
bị, hôm nay, hôm qua, ngày, tháng, năm, lúc, khi, trước, sau, rồi, đã từng, ạ, à, ừ, ừm,
nhé, nha, nhỉ, đấy, đó, thôi, cơ, mà, chứ, làm, đi, đến, ra, vào, ở, nói, biết, thấy,
nghĩ
"""

VIETNAMESE = tuple(dict.fromkeys(" ".join(_LISTED.split()).split(", ")))
